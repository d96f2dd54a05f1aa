"""Reading, writing, appending and staging panels."""

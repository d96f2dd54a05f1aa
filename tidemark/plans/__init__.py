"""SQL steps, test panels and the registry of named queries."""

"""Customer-panel analytics on Spark DataFrames."""

from .spec import BANK_PANEL, PanelSpec

__all__ = ["BANK_PANEL", "PanelSpec"]

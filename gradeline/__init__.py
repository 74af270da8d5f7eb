"""Quality analytics on labelled feature tables, as functions from DataFrame to DataFrame."""

from gradeline.config import LABEL_MAP, TableSpec

__all__ = ["LABEL_MAP", "TableSpec"]

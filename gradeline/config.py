"""The one description of a labelled feature table that every operator takes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Accepted label spellings (compared in lower case) and their class.
LABEL_MAP = {"bad": 0, "good": 1, "0": 0, "1": 1, "false": 0, "true": 1}


@dataclass(frozen=True)
class TableSpec:
    """Names of the id, feature and label columns, and the label spellings."""

    id_col: str | None
    feature_cols: tuple[str, ...]
    label_col: str
    label_map: Mapping[str, int] = field(default_factory=lambda: dict(LABEL_MAP))

"""Rows as pandas frames."""

from __future__ import annotations

import pandas as pd


def frame(rows: list[tuple], columns: list[str], whole: tuple[str, ...] = ()) -> pd.DataFrame:
    """``rows`` as a frame in which the columns in ``whole`` stay whole numbers beside nulls (a plain frame would round large ones)."""
    by = list(zip(*rows, strict=True)) if rows else [()] * len(columns)
    return pd.DataFrame({c: pd.array(v, dtype="Int64") if c in whole else pd.Series(v, dtype=object) for c, v in zip(columns, by, strict=True)})

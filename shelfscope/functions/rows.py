"""Row helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that later steps read as values.

    The optimizer moves filters down through projections and repeats the column expressions in
    them; for parsed JSON that multiplies with every step. A one-row `inline` is a point it does
    not move filters across, so the expressions stay in one place.
    """
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))

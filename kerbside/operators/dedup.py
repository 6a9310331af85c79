"""Keep-latest dedup.

``row_number() OVER (PARTITION BY key ORDER BY ... DESC) = 1`` plans as a
partial ``WindowGroupLimit`` before the shuffle and a final one after it, so a
hot key (even the NULL-key group, which collapses to one row) reaches its
reducer as at most one row per map task rather than all of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _desc(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_last()


def dedup_latest(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str | Column],
                 rank_col: str = "_rn") -> DataFrame:
    """One row per key: the greatest ``order_by`` (all DESC, NULLs last).

    ``order_by`` must end in columns that break ties; the reference leaves
    ties arbitrary, which makes reruns disagree.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*[_desc(c) for c in order_by])
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) == 1)
              .drop(rank_col))

"""Latest row per key.

Both strategies reduce rows *before* the shuffle, so a key holding a third of the
rows costs one partial row per map task, not a third of the data in one task:

* ``latest_by_agg`` - ``max_by(row, struct(order))`` per key: partial + final
  aggregate (map-side combine).
* ``latest_by_window`` - ``row_number() = 1`` over the key: Spark plans a
  ``WindowGroupLimit`` on both sides of the shuffle.

Order columns are all DESC with NULLs last. Wrapping them in a struct keeps rows
whose order values are NULL (``max_by`` skips a NULL ordering value; a struct is
never NULL and sorts NULL members lowest). NULL keys form one group, as in SQL.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .project import q

_LATEST = "__latest"


def latest_by_agg(df: DataFrame, keys: Sequence[str], ordering: Sequence[str]) -> DataFrame:
    """Newest row per key by aggregation; output has the input's columns."""
    keys = list(keys)
    if all(c in keys for c in df.columns):
        return df.select(*[q(c) for c in df.columns]).distinct()
    row = F.struct(*[q(c) for c in df.columns if c not in keys])
    order = F.struct(*[q(c) for c in ordering])
    # keys come out as the grouping columns themselves, so the result keeps its hash
    # partitioning on the keys and a following join or merge on them needs no shuffle
    return (df.groupBy(*[q(k) for k in keys])
              .agg(F.max_by(row, order).alias(_LATEST))
              .select(*[(q(c) if c in keys else F.col(_LATEST)[c].alias(c)) for c in df.columns]))


def latest_by_window(df: DataFrame, keys: Sequence[str], ordering: Sequence[str],
                     rank_col: str | None = "RNK") -> DataFrame:
    """Newest row per key by ``row_number``; keeps the rank column unless
    ``rank_col`` is None."""
    w = Window.partitionBy(*[q(k) for k in keys]).orderBy(*[q(c).desc_nulls_last() for c in ordering])
    name = rank_col or "__rnk"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) == 1)
    return out if rank_col else out.drop(name)


def latest(df: DataFrame, keys: Sequence[str], ordering: Sequence[str], strategy: str = "agg") -> DataFrame:
    """Dispatch on the strategy name; unknown names use the aggregate form."""
    if strategy.lower() in ("window", "row_num"):
        return latest_by_window(df, keys, ordering, rank_col=None)
    return latest_by_agg(df, keys, ordering)

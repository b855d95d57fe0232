"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that a single task may take. Keys above it are split over several tasks.
ROWS_PER_TASK = 1_000_000

# Dimension rows that are broadcast; a larger dimension is joined by shuffle.
BROADCAST_ROWS = 100_000


def _same(keys: list[str], other: str, null_keys: bool) -> str:
    equal = "<=>" if null_keys else "="
    return " and ".join(f"{k} {equal} {other}{k}" for k in keys)


def spread_join(rows: DataFrame, facts: DataFrame, keys: list[str], size: str, spread: str,
                rows_per_task: int | None = None, null_keys: bool = False) -> DataFrame:
    """Inner join of `rows` to `facts`, one fact per key, splitting keys that hold too many rows.

    `facts[size]` is the number of rows its key has. A key with more than `rows_per_task` of them
    is cut into parts by the hash of `spread`, a column of `rows` that differs from row to row,
    and its fact is copied to every part. The list of such keys has at most
    `row count / rows_per_task` entries, so it is broadcast. With `null_keys`, NULL keys match each
    other; without it, rows with a NULL key must not be many, since they meet in one task.
    """
    limit = rows_per_task or ROWS_PER_TASK
    parts = f"cast(ceil({size} / {limit}) as int)"
    large = facts.filter(f"{size} > {limit}").selectExpr(
        *[f"{k} as _large_{k}" for k in keys], f"{parts} as _parts")
    split = rows.join(F.broadcast(large), F.expr(_same(keys, "_large_", null_keys)), "left").selectExpr(
        *rows.columns, f"cast(coalesce(pmod(xxhash64({spread}), _parts), 0) as int) as _part")
    others = [c for c in facts.columns if c not in keys]
    copied = facts.selectExpr(
        *[f"{k} as _fact_{k}" for k in keys], *others,
        f"explode(sequence(0, greatest({parts}, 1) - 1)) as _fact_part")
    same = f"{_same(keys, '_fact_', null_keys)} and _part = _fact_part"
    return split.join(copied, F.expr(same)).select(*rows.columns, *others)


def is_small(df: DataFrame, max_rows: int | None = None) -> bool:
    """True when `df` has at most `max_rows` rows; reads no more than that many."""
    limit = max_rows or BROADCAST_ROWS
    return df.limit(limit + 1).count() <= limit


def lookup(rows: DataFrame, dim: DataFrame, key: str, spread: str, broadcast: bool,
           rows_per_task: int | None = None) -> DataFrame:
    """Left join `rows` to a dimension with one row per `key`.

    `broadcast` is the outcome of `is_small(dim)`. A dimension too large for that is joined by
    shuffle, with the row count of each key taken first so that common keys are split; keys the
    dimension does not know, and NULL, are counted and split too.
    """
    if broadcast:
        return rows.join(F.broadcast(dim), key, "left").select(
            *rows.columns, *[c for c in dim.columns if c != key])
    sized = rows.groupBy(key).agg(F.expr("count(*) as _rows")).join(dim, key, "left")
    return spread_join(rows, sized, [key], "_rows", spread, rows_per_task,
                       null_keys=True).drop("_rows")


def repeats(rows: DataFrame, keys: list[str], order: list[str], original: str, spread: str,
            rows_per_task: int | None = None, null_keys: bool = False) -> DataFrame:
    """Every row of a group but its first, with the first row's `original` column attached.

    `order` names (nullable ascending, NULL last) the columns that rank a group; the last of them
    must differ from row to row. Groups are aggregated before the join, so a group of any size
    stays spread over tasks.
    """
    rank = "struct(" + ", ".join(f"{c} is null as _no_{c}, {c} as _by_{c}" for c in order) + ")"
    # Naming `_first` in the filter keeps the plan of both uses of the groups equal, so that the
    # second reuses the exchange of the first.
    groups = (rows.groupBy(*keys)
              .agg(F.expr(f"min({rank}) as _first"), F.expr("count(*) as _rows"))
              .filter("_rows > 1 and _first is not null"))
    return (spread_join(rows, groups, keys, "_rows", spread, rows_per_task, null_keys)
            .filter(f"{rank} <> _first")
            .selectExpr(*rows.columns, f"_first._by_{original} as original_{original}"))

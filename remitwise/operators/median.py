"""Exact quantiles of amounts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from remitwise.operators.selection import values_at


def exact_quantiles(df: DataFrame, amount: str, median: str, **percents: int) -> DataFrame:
    """One row: the median of non-negative amounts in cents, the mean of the middle two, and under
    each name in `percents` the least amount that so many percent do not exceed.

    NULL for no amounts. Every rank is found by counting leading digits (`values_at`).
    """
    def ranks(n: int) -> list[int]:
        return [(n + 1) // 2, (n + 2) // 2, *(max(1, -(-p * n // 100)) for p in percents.values())]

    found = values_at(df, f"{amount} * 100", ranks)
    middle = f"cast('{sum(found[:2])}' as decimal(38,0)) / 200" if found else "null"
    others = [f"cast('{v}' as decimal(38,0)) / 100" for v in found[2:]] or ["null"] * len(percents)
    return df.sparkSession.range(1).selectExpr(
        f"cast({middle} as decimal(38,3)) as {median}",
        *[f"cast({v} as decimal(38,2)) as {name}" for v, name in zip(others, percents, strict=True)])


def exact_median(df: DataFrame, amount: str, name: str) -> DataFrame:
    """One row with the median alone."""
    return exact_quantiles(df, amount, name)

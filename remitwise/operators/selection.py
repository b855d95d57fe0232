"""Exact ranks and exact numbers without sorting: histograms of leading digits, refined where needed.

A histogram has a bounded number of buckets, counted map side first, and is all that reaches the driver.
Only a bucket that holds a wanted rank is counted again by its next digits, until it holds one value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Digits of an amount per round: at most 10,000 buckets for each open rank.
DIGITS = 4
# Bits of an order value, and bits per round: at most 4,096 buckets per kind and open bucket.
ORDER_BITS, ROUND_BITS = 60, 12


def values_at(df: DataFrame, whole: str, ranks: Callable[[int], list[int]]) -> list[int]:
    """The values at some ranks, from 1, of a column of whole non-negative numbers; NULL is left out.

    `ranks` gives the ranks for a number of values; for none it is not asked and the list is empty.
    """
    rows = df.selectExpr(f"cast({whole} as decimal(38,0)) as v").filter("v is not null")
    n, most = rows.agg(F.expr("count(*)"), F.expr("max(v)")).first()
    if not n:
        return []
    length = -(-len(str(most)) // DIGITS) * DIGITS
    text = rows.selectExpr(f"lpad(cast(v as string), {length}, '0') as v")
    # The digits known of the value at each rank, and its rank among the values that begin with them.
    known = [("", rank) for rank in ranks(n)]
    for done in range(0, length, DIGITS):
        heads = sorted({head for head, _ in known})
        listed = ", ".join(f"'{head}'" for head in heads)
        upto = done + DIGITS
        counted = (text.filter(f"substr(v, 1, {done}) in ({listed})")
                   .groupBy(F.expr(f"substr(v, 1, {upto}) as head")).count())
        buckets = sorted(map(tuple, counted.collect()))
        known = [_step(buckets, head, rank) for head, rank in known]
    return [int(head) for head, _ in known]


def _step(buckets: list[tuple[str, int]], head: str, rank: int) -> tuple[str, int]:
    """The bucket below `head` that holds a rank, and the rank in it."""
    for bucket, size in buckets:
        if bucket.startswith(head):
            if rank <= size:
                return bucket, rank
            rank -= size
    raise ValueError("a rank beyond the number of values")


@dataclass
class Leaf:
    """A range of order values, [low, low + 2**bits), and its rows per kind."""

    low: int
    bits: int
    counts: dict[int, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Quota:
    """So many rows of some kinds."""

    name: str
    number: int
    kinds: frozenset[int]


def _leaves(rows: DataFrame, bits: int) -> list[Leaf]:
    """The rows of (kind, u) counted by kind and the bits of u above the last `bits`."""
    counted = rows.groupBy(F.expr(f"shiftright(u, {bits}) as head"), "kind").count().collect()
    out: dict[int, Leaf] = {}
    for head, kind, n in counted:
        out.setdefault(head, Leaf(head << bits, bits)).counts[kind] = n
    return [out[head] for head in sorted(out)]


def _deal(leaves: list[Leaf], quotas: list[Quota]
          ) -> tuple[dict[int, list[tuple[int, str]]], list[Leaf], dict[str, int]]:
    """(per kind, up to which u which quota takes it; leaves in which a quota fills up; what is open).

    Behind such a leaf the result is only a guess, good enough to tell which leaves to count again.
    """
    left = {q.name: q.number for q in quotas}
    ends: dict[int, list[tuple[int, str]]] = {}
    filling = []
    for leaf in leaves:
        takers = {kind: next((q.name for q in quotas if kind in q.kinds and left[q.name]), None)
                  for kind in leaf.counts}
        taken: dict[str, int] = {}
        for kind, name in takers.items():
            if name:
                taken[name] = taken.get(name, 0) + leaf.counts[kind]
        if any(n > left[name] for name, n in taken.items()):
            filling.append(leaf)
            for kind, n in leaf.counts.items():
                for q in quotas:
                    some = min(n, left[q.name]) if kind in q.kinds else 0
                    left[q.name] -= some
                    n -= some
            continue
        for name, n in taken.items():
            left[name] -= n
        for kind, name in takers.items():
            if name:
                listed = ends.setdefault(kind, [])
                if listed and listed[-1][1] == name:
                    listed.pop()
                listed.append((leaf.low + (1 << leaf.bits), name))
    return ends, filling, left


def deal_exactly(rows: DataFrame, quotas: list[Quota]) -> tuple[str, dict[str, int]]:
    """(SQL text over kind and u that names the quota of a row or is NULL, what no row was left for).

    `rows` has (kind, u): a small number and a distinct whole number below 2**ORDER_BITS. Taken in
    the order of u, every row goes to the first quota of its kind that is not full, so each quota gets
    the first rows of its kinds that earlier quotas leave, and no row goes to two.
    """
    leaves = _leaves(rows, ORDER_BITS - ROUND_BITS)
    while True:
        ends, filling, left = _deal(leaves, quotas)
        if not filling:
            break
        if filling[0].bits == 0:
            raise ValueError("rows share an order value; choose another seed")
        finer = []
        # Leaves of one width are counted again in one job.
        bits = filling[0].bits
        again = [leaf for leaf in filling if leaf.bits == bits]
        ranges = " or ".join(f"u between {x.low} and {x.low + (1 << bits) - 1}" for x in again)
        finer = _leaves(rows.filter(ranges), bits - ROUND_BITS)
        old = {id(leaf) for leaf in again}
        leaves = sorted([x for x in leaves if id(x) not in old] + finer, key=lambda x: x.low)
    arms = [f"when kind = {kind} and u < {end} then '{name}'"
            for kind, listed in ends.items() for end, name in listed]
    return (f"case {' '.join(arms)} end" if arms else "cast(null as string)"), left

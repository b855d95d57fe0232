"""Operator 9: exact top-k search by multi-resolution segment statistics.

Vectors are cut into segments; a segment is known by its mean and its deviation (the length of what
is left when the mean is taken away). For a query q and a candidate x, by Cauchy-Schwarz,

    q . x  <=  sum over segments of  size * mean(q) * mean(x) + deviation(q) * deviation(x)

so this bounds the distance -(q . x) from below, more tightly with finer segments. Resolutions go from
two segments over eight to segments of one component each for seven eighths of the vector, with short
segments for the rest (`resolutions`). At each of them the candidates with the best bounds are scored
exactly; the k-th score so far is the threshold that the bounds of the others must reach. What survives
the finest is scored exactly, and nothing else is.

Rows are blocked by the signs of their eight means. Each query first searches the block that it is in;
the k-th score found there is a threshold that it carries to the other blocks. A pair of blocks is
compared, and its rows are shuffled to it, only if the ranges of means and the greatest deviations of
both allow a score that some query of the block still needs. A pair is one task's work, of bounded
size, and returns at most k rows per query; the k best of those are the result. Nothing is broadcast but
the numbers of rows by signs, at most 256 per length of vectors.

Vectors that are null or hold null or non-finite components, and rows without vec_id, take no part.
Vectors are compared with vectors of their length; those without components score 0. A query's own
row is told by its vec_id. Ties go to the smaller vec_id. Rows that repeat a vec_id are candidates one
by one; where they are queries, their candidates are ranked together, as those of one query. An empty
table gives no rows. Extra columns are ignored. A score beyond the range of a long raises.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitwise.llm.common import land, pick, ship
from remitwise.llm.negatives import blocked

QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 8192
# Queries that are compared with a block at once.
STEP = 512
# Parts into which the comparison of envelopes is dealt.
DEALT = 16
# Room for rounding, relative; an unjust survivor costs time only.
ROUNDING = 1e-9


def vectors(table: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    return (pick(table, "vec_id", "embedding")
            .filter("vec_id is not null and embedding is not null and forall(embedding, x -> "
                    "x is not null and not isnan(x) and abs(x) < double('infinity'))")
            .selectExpr("vec_id", "transform(embedding, x -> 64 * cast(x as double)) as v"))


def resolutions(size: int) -> list[np.ndarray]:
    """Starts of the segments, coarse to fine."""
    half, eighth, short = (-(-size // n) or 1 for n in (2, 8, 16))
    single = size - size // 8
    return [np.arange(0, size, half), np.arange(0, size, eighth),
            np.concatenate([np.arange(single), np.arange(single, size, short)])]


def statistics(x: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled means and deviations of the segments of each row."""
    size = np.diff(np.append(cuts, x.shape[1]))
    mean = np.add.reduceat(x, cuts, axis=1) / size
    rest = x - np.repeat(mean, size, axis=1)
    return mean * np.sqrt(size), np.sqrt(np.add.reduceat(rest * rest, cuts, axis=1))


def lists(x: np.ndarray) -> pa.ListArray:
    n, width = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()),
                                    pa.array(x.ravel()))


def matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), size)


def summarised(rows: DataFrame) -> DataFrame:
    """Rounds v down and adds size, the statistics of its eight segments, and near, their signs."""

    def work(batches):
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                v = np.floor(matrix(part.column(1), size))
                mean = deviation = np.zeros((len(v), 0))
                if size:
                    mean, deviation = statistics(v, resolutions(size)[1])
                near = ((mean > 0) << np.arange(mean.shape[1])).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists(v), pa.array(np.full(len(v), size, np.int32)), lists(mean),
                     lists(deviation), pa.array(near.astype(np.int64))],
                    ["vec_id", "v", "size", "mean", "deviation", "near"])

    ship(rows.sparkSession)
    return rows.mapInArrow(work, "vec_id bigint, v array<double>, size int, mean array<double>, "
                                 "deviation array<double>, near bigint")


def envelopes(rows: DataFrame, name: str) -> DataFrame:
    """Per block the range of each segment's means and its greatest deviation."""
    return rows.select("size", name).distinct().join(
        rows.select("size", name, F.posexplode(F.arrays_zip("mean", "deviation")).alias("i", "s"))
        .groupBy("size", name, "i").agg(
            F.expr("min(s.mean) as lo"), F.expr("max(s.mean) as hi"),
            F.expr("max(s.deviation) as deviation"))
        .groupBy("size", name).agg(F.expr(
            "array_sort(collect_list(struct(i, lo, hi, deviation))) as ranges")),
        ["size", name], "left")


def block_pairs(asked: DataFrame, blocks: DataFrame) -> DataFrame:
    """(query_block, block): pairs with a score that may reach `least`."""
    a = asked.selectExpr("size", "query_block", "ranges as a", "least",
                         f"cast(pmod(xxhash64(query_block), {DEALT}) as int) as dealt")
    b = blocks.selectExpr("size", "block", "ranges as b",
                          f"explode(sequence(0, {DEALT - 1})) as dealt")
    bounded = a.join(b, ["size", "dealt"]).selectExpr(
        "query_block", "block", "least",
        "aggregate(zip_with(a, b, (p, q) -> greatest(p.lo * q.lo, p.lo * q.hi, p.hi * q.lo, "
        "p.hi * q.hi) + p.deviation * q.deviation), 0d, (s, x) -> s + x) as far",
        "aggregate(zip_with(a, b, (p, q) -> greatest(abs(p.lo), abs(p.hi)) * "
        "greatest(abs(q.lo), abs(q.hi)) + p.deviation * q.deviation), 1d, (s, x) -> s + x) as scale")
    return bounded.filter(f"coalesce(far + {ROUNDING} * (scale + abs(least)) >= least, true)").select(
        "query_block", "block")


def best(q: np.ndarray, x: np.ndarray, alive: np.ndarray, least: np.ndarray, rank: np.ndarray,
         k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(query, candidate, score) of the k best candidates of each query, as places, and the number of
    pairs alive at first and after each resolution.

    `alive` tells which pairs may count, `least` the score that is needed, `rank` the order of
    candidates of one score, smaller first.
    """
    n, m = alive.shape
    score = np.full((n, m), -np.inf)
    left = [int(alive.sum())]
    # No bound, nor any sum on the way to it, is larger than the product of these.
    length = [np.sqrt((v * v).sum(axis=1)) for v in (q, x)]

    def scored(row: int, places: np.ndarray) -> None:
        new = places[score[row, places] == -np.inf]
        score[row, new] = x[new] @ q[row]

    for cuts in resolutions(x.shape[1]) if x.shape[1] else []:
        rows, columns = (np.flatnonzero(alive.any(axis=axis)) for axis in (1, 0))
        if not len(rows) or m <= k:
            break
        (qm, qd), (xm, xd) = statistics(q[rows], cuts), statistics(x[columns], cuts)
        wide = np.diff(np.append(cuts, x.shape[1])) > 1  # one component does not deviate
        bound = qm @ xm.T + qd[:, wide] @ xd[:, wide].T
        bound += ROUNDING * (np.outer(length[0][rows], length[1][columns]) + 1)
        part = alive[np.ix_(rows, columns)]
        bound[~part] = -np.inf
        if len(columns) > 2 * k:
            first = np.argpartition(-bound, 2 * k, axis=1)[:, :2 * k]
            for i, row in enumerate(rows):
                scored(row, columns[first[i][part[i, first[i]]]])
                if (known := np.flatnonzero(score[row] > -np.inf)).size >= k:
                    least[row] = max(least[row], np.partition(score[row, known], -k)[-k])
        alive[np.ix_(rows, columns)] = part & (bound >= least[rows, None])
        left.append(int(alive.sum()))
    out = []
    for row in range(n):
        scored(row, np.flatnonzero(alive[row]))
        places = np.flatnonzero(alive[row] & (score[row] >= least[row]))
        places = places[np.lexsort((rank[places], -score[row, places]))][:k]
        out.append((np.full(len(places), row), places, score[row, places]))
    rows, places, found = (np.concatenate(c) for c in zip(*out, strict=True))
    return rows, places, found.astype(np.int64), left


def by_hand(q: np.ndarray, x: np.ndarray, alive: np.ndarray, rank: np.ndarray, k: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For components so large that only whole numbers of any length are exact."""
    out = []
    theirs = [[int(c) for c in v] for v in x]
    for i, own in enumerate([int(c) for c in v] for v in q):
        scores = [(-sum(a * b for a, b in zip(own, theirs[j], strict=True)), rank[j], j)
                  for j in np.flatnonzero(alive[i]).tolist()]
        out += [(i, j, -s) for s, _, j in sorted(scores)[:k]]
    rows, place, score = (list(c) for c in zip(*out, strict=True)) if out else ([], [], [])
    return np.array(rows, np.int64), np.array(place, np.int64), np.array(score, dtype=np.int64)


def search(queries: DataFrame, rows: DataFrame, k: int, home: bool) -> DataFrame:
    """(query_id, vec_id, score): the best rows per query and pair of blocks.

    With `home` each query is compared with the block that it is in, else with all but that one.
    """
    names = ["query_id", "vec_id", "score"]

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [pa.table([pa.array([], pa.int64())] * 3, names)]
        if left.num_rows and right.num_rows:
            size = left.column("size")[0].as_py()
            other, x = right.column("vec_id").to_numpy(), matrix(right.column("v"), size)
            block, rank = right.column("block")[0].as_py(), other.argsort(kind="stable").argsort()
        for at in range(0, left.num_rows if right.num_rows else 0, STEP):
            part = left.slice(at, STEP)
            ids, q = part.column("vec_id").to_numpy(), matrix(part.column("v"), size)
            alive = ids[:, None] != other[None, :]
            if not home:
                alive &= np.array([h != block for h in part.column("home").to_pylist()])[:, None]
            least = part.column("least").to_numpy().copy()
            most = np.abs(q).max(initial=1) * np.abs(x).max(initial=1) * max(1, size)
            if most >= 2**52:
                row, place, score = by_hand(q, x, alive, rank, k)
            else:
                row, place, score, _ = best(q, x, alive, least, rank, k)
            out.append(pa.table([ids[row], other[place], score], names))
        return pa.concat_tables(out)

    ship(rows.sparkSession)
    return queries.groupBy("query_block", "block").cogroup(
        rows.groupBy("query_block", "block")).applyInArrow(
        work, "query_id bigint, vec_id bigint, score bigint")


def ranked(found: DataFrame, k: int) -> DataFrame:
    return found.selectExpr(
        "*", "cast(row_number() over (partition by query_id order by score desc, vec_id) as int)"
             " as rank").filter(F.col("rank") <= k)


def top_k(table: DataFrame, query: str = "vec_id % 20 = 0", k: int = 20,
          query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score); `query` is a condition on vec_id."""
    rows = land(blocked(land(summarised(vectors(table)), "summaries"), candidate_block, "block"),
                "vectors")
    queries = blocked(rows.filter(query).withColumnRenamed("block", "home"), query_block,
                      "query_block")
    lowest = "double('-infinity')"
    # Scores to beat: each query with the block that it is in itself.
    own = land(search(
        rows.filter(query).selectExpr("vec_id", "v", "size", "block", "block as query_block",
                                      f"{lowest} as least"),
        rows.selectExpr("vec_id", "v", "block", "block as query_block"), k, True), "own")
    # A score so large that a double cannot hold it is bounded by the room for rounding.
    beat = ranked(own, k).groupBy("query_id").agg(F.expr(
        f"if(count(*) < {k}, {lowest}, cast(min(score) as double)) as least"))
    asked = land(queries.join(beat, F.expr("vec_id = query_id"), "left").selectExpr(
        *queries.columns, f"coalesce(least, {lowest}) as least"), "asked")
    limits = asked.groupBy("query_block").agg(F.expr("min(least) as least"))
    pairs = land(block_pairs(envelopes(asked, "query_block").join(limits, "query_block"),
                             envelopes(rows, "block")), "pairs")
    found = search(asked.select("vec_id", "v", "size", "home", "least", "query_block")
                   .join(pairs, "query_block"),
                   rows.select("vec_id", "v", "block").join(pairs, "block"), k, False)
    return ranked(found.unionByName(own), k).select("query_id", "rank", "vec_id", "score")

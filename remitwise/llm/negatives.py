"""Operator 11: hard negatives by angular triangle filtering.

Components become whole numbers, floor(scale * x). For every dimension there are fixed orthonormal
reference directions, seven eighths of a basis, the same on every machine. A row stores its norm and
its angles to them. From the angles a[i] and b[i] of two rows the cosine between the rows lies within

    sum cos a[i] cos b[i]  -+  sqrt(1 - sum cos^2 a[i]) * sqrt(1 - sum cos^2 b[i])

which for one direction is the triangle inequality cos(a + b) <= cos <= cos(a - b). Times both norms,
and with room for rounding, this bounds the score from both sides, and only pairs whose bounds overlap
the wanted window are scored, in integers.

Rows are dealt into blocks by the two directions that they are nearest to, so that the rows of a block
are alike where the data are; a block stores the range of its angles, and bounds made of two blocks'
ranges tell which pairs of blocks cannot hold a wanted score. These are never sent anywhere. Three
passes: each anchor with one block near it, which gives scores to beat; the best rows of its own label;
then, per positive, the best rows of other labels in the window low * positive <= 100 * score <=
high * positive. Candidates for the k best of a pass are first taken by the bounds, and the k-th score
found closes the window further.

A row without vec_id or label, without a vector, or with a null or non-finite component takes no part. Of
rows that share a vec_id the least by label, then by components, takes part. Vectors are compared
with vectors of their length; those without components score 0. Ties go to the smaller vec_id. Extra
columns are ignored; an empty table gives no rows. Scores beyond the range of a long raise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitwise.llm.common import land, pick, ship

# Rows of a block of anchors and of candidates.
ANCHORS, CANDIDATES = 512, 4096
# Parts that the blocks of anchors are dealt into when they meet the blocks of candidates.
DEALT = 32
# Room for the rounding of stored angles, per root of a component, as a share of two norms' product.
ROUNDING = 1e-6

_DIRECTIONS: dict[int, np.ndarray] = {}


def directions(size: int) -> np.ndarray:
    """Orthonormal reference directions, as columns, for vectors of a size."""
    if size not in _DIRECTIONS:
        some = np.random.Generator(np.random.PCG64(size)).standard_normal((size, size))
        _DIRECTIONS[size] = np.linalg.qr(some)[0][:, :max(1, size * 7 // 8)] if size else some
    return _DIRECTIONS[size]


def vectors(table: DataFrame, scale: int, label: str) -> DataFrame:
    """(vec_id, label, v, size) of the rows that take part, one per vec_id."""
    rows = (pick(table, "vec_id", "label", "embedding")
            .filter("vec_id is not null and label is not null and embedding is not null and "
                    "forall(embedding, x -> x is not null and not isnan(x) and "
                    "abs(x) < double('infinity'))")
            .selectExpr("cast(vec_id as bigint) as vec_id", f"{label} as label",
                        f"transform(embedding, x -> {scale} * cast(x as double)) as v"))
    return rows.groupBy("vec_id").agg(F.expr("min(struct(label, v)) as r")).selectExpr(
        "vec_id", "cast(r.label as bigint) as label", "r.v as v", "size(r.v) as size")


def angled(rows: DataFrame) -> DataFrame:
    """Rounds v down and adds norm, angles, and near: the two directions of the smallest angles, with
    their sides."""

    def work(batches):
        for batch in batches:
            for size in np.unique(batch.column(3).to_numpy()).tolist():
                part = batch.filter(pa.array(batch.column(3).to_numpy() == size))
                n = part.num_rows
                v = np.floor(part.column(2).flatten().to_numpy().reshape(n, size))
                norm = np.sqrt((v * v).sum(axis=1))
                unit = v / np.maximum(norm, 1)[:, None]
                cos = np.clip(unit @ directions(size), -1, 1)
                count = cos.shape[1]
                near = np.zeros(n, np.int64)
                if count:
                    order = np.argsort(-np.abs(cos), axis=1, kind="stable")[:, :2]
                    side = 2 * order + (np.take_along_axis(cos, order, 1) < 0)
                    near = side[:, 0] * 2 * count + side[:, -1]
                angles = pa.ListArray.from_arrays(
                    pa.array(np.arange(n + 1) * count, pa.int32()),
                    pa.array(np.arccos(cos).astype(np.float32).ravel()))
                whole = pa.ListArray.from_arrays(
                    pa.array(np.arange(n + 1) * size, pa.int32()), pa.array(v.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], whole, part.column(3), pa.array(norm), angles, pa.array(near)],
                    ["vec_id", "label", "v", "size", "norm", "angles", "near"])

    ship(rows.sparkSession)
    return rows.mapInArrow(work, "vec_id bigint, label bigint, v array<double>, size int, "
                                 "norm double, angles array<float>, near bigint")


def blocked(rows: DataFrame, limit: int, name: str) -> DataFrame:
    """Adds the block of each row: cells of one `near` in order, as many as fill a block; a cell of
    more rows is blocks of its own, dealt by a hash."""
    # At most four times the square of the directions' number per size of vectors.
    cells = rows.groupBy("size", "near").agg(F.expr("count(*) as n"))
    order = "partition by size order by near"
    cells = cells.selectExpr("*", f"cast(ceil(n / {limit}) as int) as parts",
                             f"if(n > {limit}, 0, n) as few")
    cells = cells.selectExpr(
        "size as _size", "near as _near", "parts",
        f"concat(size, '-', if(parts > 1, concat('c', near), "
        f"cast((sum(few) over ({order}) - few) div {limit} as string))) as cell")
    return rows.join(cells, F.expr("size = _size and near = _near")).selectExpr(
        *rows.columns, f"concat(cell, '-', pmod(xxhash64(vec_id), parts)) as {name}")


def envelopes(rows: DataFrame, name: str) -> DataFrame:
    """Per block the ranges of its norms, and of its cosines and the rest beside each direction."""
    return rows.groupBy("size", name).agg(
        F.expr("min(norm) as norm_lo"), F.expr("max(norm) as norm_hi")).join(
        rows.select("size", name, F.posexplode("angles").alias("i", "angle"))
        .groupBy("size", name, "i").agg(F.expr("min(angle) as lo"), F.expr("max(angle) as hi"))
        .groupBy("size", name).agg(F.expr(
            "array_sort(collect_list(struct(i, cos(hi) as lo, cos(lo) as hi))) as ranges")),
        ["size", name], "left")


def block_pairs(anchors: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pairs of blocks whose scores may reach `least` and need not pass `most` of the anchor block."""
    a = anchors.selectExpr("size", "ablock", "norm_lo as a_lo", "norm_hi as a_hi",
                           "ranges as a_ranges", "least", "most",
                           f"cast(pmod(xxhash64(ablock), {DEALT}) as int) as dealt")
    b = blocks.selectExpr("size", "block", "norm_lo as b_lo", "norm_hi as b_hi", "ranges as b_ranges",
                          f"explode(sequence(0, {DEALT - 1})) as dealt")
    room = f"{ROUNDING} * sqrt(size)"
    corners = "p.lo * q.lo, p.lo * q.hi, p.hi * q.lo, p.hi * q.hi"
    small = ("aggregate({}_ranges, 0d, (s, r) -> s + if(r.lo <= 0 and r.hi >= 0, 0d, "
             f"least(r.lo * r.lo, r.hi * r.hi)), s -> sqrt(greatest(0d, 1 - s) + {room}))")
    pairs = a.join(b, ["size", "dealt"]).selectExpr(
        "*", f"{small.format('a')} * {small.format('b')} as rest",
        f"zip_with(a_ranges, b_ranges, (p, q) -> struct(least({corners}) as lo, "
        f"greatest({corners}) as hi)) as products")
    pairs = pairs.selectExpr(
        "ablock", "block", "least", "most", "a_lo * b_lo as near", "a_hi * b_hi as far",
        f"least(1d, aggregate(products, rest, (s, r) -> s + r.hi)) + {room} as hi",
        f"greatest(-1d, aggregate(products, -rest, (s, r) -> s + r.lo)) - {room} as lo")
    return pairs.filter("coalesce(greatest(far * hi, near * hi) >= least - 1 and "
                        "least(far * lo, near * lo) <= most + 1, true)").select("ablock", "block")


class Block:
    """Rows of one block as arrays, ordered by id."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks().sort_by("vec_id")
        self.rows, n = rows, rows.num_rows
        size = rows.column("size")[0].as_py()
        self.ids, self.labels, self.norm = (rows.column(c).to_numpy() for c in ("vec_id", "label", "norm"))
        self.v = rows.column("v").combine_chunks().flatten().to_numpy().reshape(n, size)
        angles = rows.column("angles").combine_chunks().flatten().to_numpy().reshape(n, -1)
        self.cos = np.cos(angles.astype(np.float64))
        self.room = ROUNDING * size**0.5
        self.rest = np.sqrt(np.maximum(0, 1 - (self.cos**2).sum(axis=1)) + self.room)


def bounds(a: Block, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest score that each pair can have."""
    middle, rest = a.cos @ b.cos.T, np.multiply.outer(a.rest, b.rest) + a.room
    scale = np.multiply.outer(a.norm, b.norm)
    return (scale * np.maximum(middle - rest, -1 - a.room) - 1,
            scale * np.minimum(middle + rest, 1 + a.room) + 1)


def scores(a: Block, b: Block, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Inner products of pairs, in integers."""
    if max(a.norm.max(initial=0) * b.norm.max(initial=0), np.abs(a.v).max(initial=0),
           np.abs(b.v).max(initial=0)) >= 2.0**62:
        x, y = ([[int(c) for c in r] for r in m.v] for m in (a, b))
        return np.array([sum(map(int.__mul__, x[i], y[j])) for i, j in zip(row, column)], np.int64)
    x, y = a.v.astype(np.int64), b.v.astype(np.int64)
    out = np.empty(len(row), np.int64)
    for at in range(0, len(row), 1 << 15):
        some = slice(at, at + (1 << 15))
        out[some] = np.einsum("nd,nd->n", x[row[some]], y[column[some]])
    return out


def best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores of each group, ties to the smaller id."""
    order = np.lexsort((ids, -score, group))
    ordered = group[order]
    return order[np.arange(len(order)) - np.searchsorted(ordered, ordered) < k]


def windowed(a: Block, b: Block, may: np.ndarray, least: np.ndarray, most: np.ndarray, k: int
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(place in a, place in b, score) of the k highest scores within [least, most] of each row of
    a, among the pairs that `may` be, and the number of pairs that were scored.

    The pairs whose upper bounds are the highest come first; the k-th score they give, if all k are
    in the window, is the least that the others must reach.
    """
    lo, hi = bounds(a, b)
    alive = may & (hi >= least[:, None]) & (lo <= most[:, None])
    first = np.zeros_like(alive)
    width = min(4 * k, alive.shape[1])
    middle = np.where(alive & (hi <= most[:, None]), hi, -np.inf)
    place = np.argpartition(-middle, width - 1, axis=1)[:, :width]
    np.put_along_axis(first, place, True, 1)
    first &= alive & (hi <= most[:, None])
    rows, columns = np.nonzero(first)
    found = scores(a, b, rows, columns)
    inside = (found >= least[rows]) & (found <= most[rows])
    kept = best(rows[inside], found[inside], b.ids[columns[inside]], k)
    full = np.bincount(rows[inside][kept], minlength=len(least)) >= k
    worst = np.full(len(least), np.inf)
    np.minimum.at(worst, rows[inside][kept], found[inside][kept])
    floor = np.where(full, worst, least)
    alive &= ~first & (hi >= floor[:, None])
    more_rows, more_columns = np.nonzero(alive)
    more = scores(a, b, more_rows, more_columns)
    row, column, score = (np.concatenate(x) for x in (
        (rows, more_rows), (columns, more_columns), (found, more)))
    ok = (score >= least[row]) & (score <= most[row])
    row, column, score = row[ok], column[ok], score[ok]
    kept = best(row, score, b.ids[column], k)
    return row[kept], column[kept], score[kept], len(rows) + len(more_rows)


_FOUND = "anchor_id bigint, positive_id bigint, positive_score bigint, vec_id bigint, score bigint"


def search(anchors: DataFrame, rows: DataFrame, pairs: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """Best rows per anchor (those of its label) or, if anchors carry positives, per positive.

    Every pair of blocks is the work of one task, which takes the anchors in steps.
    """
    wanted = "positives" in anchors.columns
    names = ["anchor_id", "positive_id", "positive_score", "vec_id", "score"]

    def matched(a: Block, b: Block) -> list[pa.Table]:
        other = a.ids[:, None] != b.ids[None, :]
        same = a.labels[:, None] == b.labels[None, :]
        if not wanted:
            least = a.rows.column("least").to_numpy()
            row, column, score, _ = windowed(a, b, other & same, least,
                                             np.full(len(least), np.inf), k)
            none = pa.nulls(len(row), pa.int64())
            return [pa.table([a.ids[row], none, none, b.ids[column], score], names)]
        out = []
        lists = a.rows.column("positives").to_pylist()
        for place in range(max(map(len, lists))):
            has = np.array([i for i, p in enumerate(lists) if len(p) > place])
            some = Block(a.rows.take(pa.array(has)))
            positive = np.array([lists[i][place]["vec_id"] for i in has])
            said = np.array([lists[i][place]["score"] for i in has])
            whole, rest = np.divmod(said, 100)  # so that no product leaves the range of a long
            row, column, score, _ = windowed(some, b, ~same[has], low * whole - (-low * rest // 100),
                                             high * whole + high * rest // 100, k)
            out.append(pa.table([some.ids[row], positive[row], said[row], b.ids[column], score], names))
        return out

    def work(x: pa.Table, y: pa.Table) -> pa.Table:
        if not x.num_rows or not y.num_rows:
            return pa.table([pa.array([], pa.int64())] * 5, names)
        b = Block(y)
        return pa.concat_tables([t for at in range(0, x.num_rows, ANCHORS)
                                 for t in matched(Block(x.slice(at, ANCHORS)), b)])

    ship(rows.sparkSession)
    return anchors.join(pairs, "ablock").groupBy("ablock", "block").cogroup(
        rows.join(pairs, "block").groupBy("ablock", "block")).applyInArrow(work, _FOUND)


def ranked(found: DataFrame, group: str, k: int) -> DataFrame:
    return found.selectExpr("*", f"cast(row_number() over (partition by {group} order by score desc, "
                                 "vec_id) as int) as rank").filter(f"rank <= {k}")


def hard_negatives(table: DataFrame, anchor: str, positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100, scale: int = 256, label: str = "label",
                   anchor_block: int = ANCHORS, candidate_block: int = CANDIDATES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchor` is a condition on vec_id, `label` an expression for the label that counts.
    """
    rows = land(blocked(land(angled(vectors(table, scale, label)), "angled"), candidate_block,
                        "block"), "blocked")
    anchors = land(blocked(rows.filter(anchor).drop("block"), anchor_block, "ablock")
                   .join(rows.select(F.col("vec_id").alias("_id"), "block"),
                         F.expr("vec_id = _id")).drop("_id"), "anchors")
    blocks = land(envelopes(rows, "block"), "blocks")
    ranges = land(envelopes(anchors, "ablock"), "anchor_blocks")
    everything = "cast('-infinity' as double)"
    # Scores to beat: each anchor with the block that it is in itself.
    own = anchors.selectExpr("*", f"{everything} as least").withColumn("ablock", F.col("block"))
    pilot = search(own.drop("block"), rows, blocks.selectExpr("block as ablock", "block"), positives,
                   low, high)
    beat = ranked(pilot, "anchor_id", positives).groupBy("anchor_id").agg(F.expr(
        f"if(count(*) < {positives}, {everything}, cast(min(score) as double)) as least"))
    asked = land(anchors.drop("block").join(beat, F.expr("vec_id = anchor_id"), "left").drop("anchor_id")
                 .selectExpr("*", f"coalesce(least, {everything}) as least_").drop("least")
                 .withColumnRenamed("least_", "least"), "asked")
    limits = asked.groupBy("ablock").agg(F.expr("min(least) as least"),
                                         F.expr("double('infinity') as most"))
    pairs = land(block_pairs(ranges.join(limits, "ablock"), blocks), "positive_pairs")
    found = ranked(search(asked, rows, pairs, positives, low, high), "anchor_id", positives)
    # As long as the number of positives asked for; a negative score has no window.
    lists = found.filter("score >= 0").groupBy("anchor_id").agg(F.expr(
        "array_sort(collect_list(struct(rank, vec_id, score))) as positives"))
    asked = land(anchors.drop("block").join(lists, F.expr("vec_id = anchor_id")).drop("anchor_id"),
                 "with_positives")
    limits = asked.selectExpr("ablock", "explode(positives.score) as score").groupBy("ablock").agg(
        F.expr(f"cast(min(score) as double) * {low} / 100 as least"),
        F.expr(f"cast(max(score) as double) * {high} / 100 as most"))
    pairs = land(block_pairs(ranges.join(limits, "ablock"), blocks), "negative_pairs")
    return ranked(search(asked, rows, pairs, negatives, low, high), "anchor_id, positive_id",
                  negatives).selectExpr("anchor_id", "positive_id", "rank", "vec_id as negative_id",
                                        "positive_score", "score as negative_score")

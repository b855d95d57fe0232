"""Operator 6: near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct 5-word shingles (64-bit hashes). Documents of equal sets are one
member. Independent trees branch the members, each by `OWN` minwise functions of its own: at each node
one or two of those not yet used above it are chosen at random, and members go to the child named by
their token there. The first `LEAST_DEPTH` branchings choose 1 / similarity functions on average, the
deeper ones `DEEP` / similarity, so that the chance that two similar members meet does not run out with
depth. `plan` computes from these numbers how often a tree misses a pair of exactly the wanted
similarity at `MOST_DEPTH`, where it is missed most, and takes as many trees, ten at least, as keep that
below `MISSED` at every depth.

Nodes are branched at least `LEAST_DEPTH` times, then until they hold `LEAF` members, stop getting
smaller or lie at `MOST_DEPTH`. A leaf is compared
exhaustively: first by `COORDINATES` of the signatures (a pair is let go if so few of them agree that
a similar pair does so with a chance below `LET_GO`), then what is left of it, a cluster,
by the full sets. A cluster gives a spanning forest of its confirmed links, which holds the same
components as all of them.

A large node that keeps more than half of its parent's members holds members that agree almost
everywhere. It, like one that is still large at `MOST_DEPTH`, is compared exactly in two steps, without a
cap: its members in random blocks of `BLOCK`, each with
the node's first member, which joins nearly all of them; then whoever is not yet in the node's largest
component against every block, in portions of `BLOCK`.

Components come from the links by alternating large-star and small-star steps over written tables;
the driver sees counts and checksums only. Copies come back by a join that splits common sets.

Null or empty texts and texts without words have no set, are linked with nothing and kept. Fewer than
five words: the whole sequence is the one shingle. Null doc_id: takes part; a component has the
smallest known doc_id, or null. Repeated rows are copies: of rows with one doc_id and one text all are
marked as kept. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from math import ceil, comb, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitwise.llm.common import (
    group_cuts,
    land,
    map_batches,
    pick,
    ragged,
    runs,
    steps,
    texts_of,
    whole_groups,
)
from remitwise.operators.bloom import may_match, words_for
from remitwise.operators.skew import is_small, spread_join

WORDS = 5
SIMILAR = 85  # percent
# Coordinates that a leaf compares. Signatures hold 16 bits of each, for the trees too: values that differ
# may then look equal, which can only let more pairs meet and pass.
COORDINATES = 128
LEAST_TREES = 10
# Minwise functions of each tree.
OWN = 24
LEAST_DEPTH, MOST_DEPTH = 2, 8
DEEP = 1.5
LEAF = 128
# Members per block of a node that does not become smaller.
BLOCK = 512
# Chances that a pair of exactly the wanted similarity is lost by the trees, and in a leaf.
MISSED, LET_GO = 1e-5, 1e-6

_GAP = np.zeros(256, bool)
_GAP[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Plan(NamedTuple):
    """What follows from a similarity in percent."""

    similar: int
    more: int  # nodes of 1,000 that choose a second function, in the first branchings
    deep: int  # and below them
    trees: int
    agree: int  # least coordinates that agree

    @property
    def width(self) -> int:
        return max(COORDINATES, OWN * self.trees)


def tree_miss(similar: int, more: int, deep: int, depth: int) -> float:
    """The chance that one tree parts a pair of exactly this similarity within `depth` branchings."""
    s, missed = similar / 100, 0.0
    for same in range(OWN + 1):
        # `same` of the tree's functions agree; a node at `level` has used as many of these.
        lost = 0.0
        for level in reversed(range(depth)):
            second = (more if level < LEAST_DEPTH else deep) / 1000
            left, free = max(0, same - level), OWN - level
            one = left / free
            both = one * max(0, left - 1) / (free - 1)
            single = 1 - one + one * lost
            pair = 1 - 2 * one + both + 2 * (one - both) * lost + both * lost * lost
            lost = (1 - second) * single + second * pair
        missed += comb(OWN, same) * s ** same * (1 - s) ** (OWN - same) * lost
    return missed


@lru_cache(maxsize=4)
def plan(similar: int) -> Plan:
    """Branching rates, number of trees and least agreement for a similarity in percent."""
    more, deep = (min(1000, int(100_000 * r) // similar - 1000) for r in (1, DEEP))
    miss = max(tree_miss(similar, more, deep, d) for d in range(LEAST_DEPTH, MOST_DEPTH + 1))
    s, agree, fewer = similar / 100, 0, (1 - similar / 100) ** COORDINATES
    while fewer <= LET_GO:
        agree += 1
        fewer += comb(COORDINATES, agree) * s ** agree * (1 - s) ** (COORDINATES - agree)
    return Plan(similar, more, deep, max(LEAST_TREES, ceil(log(MISSED) / log(miss))), agree)


@lru_cache(maxsize=4)
def odd_numbers(count: int, seed: int) -> np.ndarray:
    """Fixed random odd multipliers."""
    draw = np.random.Generator(np.random.Philox(key=seed))
    return draw.integers(0, 1 << 64, count, np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A mixing of the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    import xxhash

    data, offsets = texts_of(column)
    data = _LOWER[data]
    letter = ~_GAP[data]
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] = letter[first]
    starts = np.flatnonzero(begins)
    # Words without the gaps between them lie one after the other.
    place = np.concatenate([[0], np.cumsum(letter)])
    words = runs(data[letter], np.append(place[starts], place[-1]))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.dictionary.to_pylist()),
                         np.uint64, len(words.dictionary))
    word = hashes[words.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)
    multipliers = odd_numbers(WORDS, 1)
    parts = [word * m for m in multipliers]
    ends = np.searchsorted(starts, offsets)
    rows = max(0, len(word) - WORDS + 1)
    whole = mixed(sum((p[k:k + rows] for k, p in enumerate(parts)), np.zeros(rows, np.uint64)))
    out = []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        if b - a >= WORDS:
            out.append(np.unique(whole[a:b - WORDS + 1]))
        elif b > a:
            short = sum((parts[k][a + k:a + k + 1] for k in range(b - a)),
                        np.full(1, b - a, np.uint64))
            out.append(mixed(short))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(shingles: np.ndarray) -> bytes | None:
    """16 bytes that tell a set."""
    import xxhash

    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def signatures(docs: DataFrame, own: Plan) -> DataFrame:
    """(doc_id, text_hash, n_shingles, fp, sig) of every whole text; no set: no fp, no sig."""
    rows = pick(docs, "doc_id", "text").selectExpr("doc_id", "xxhash64(text) as text_hash", "text")
    kind = rows.schema[0].dataType.simpleString()

    width = own.width

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = odd_numbers(width, 2)
        for batch in batches:
            for step in steps(batch, "text"):
                sets = shingle_sets(step.column(2))
                size = np.array([len(s) for s in sets])
                full = np.flatnonzero(size)
                sig = np.zeros((len(full), width), np.uint16)
                if len(full):
                    flat = np.concatenate([sets[i] for i in full])
                    cuts = np.cumsum(size[full]) - size[full]
                    for c, m in enumerate(multipliers):
                        least = np.minimum.reduceat(flat * m, cuts)
                        # The bits above these are those of a least value, mostly zeros.
                        sig[:, c] = ((least >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.uint16)
                lengths = np.where(size > 0, width, 0)
                yield pa.RecordBatch.from_arrays([
                    step.column(0), step.column(1), pa.array(size.astype(np.int64)),
                    pa.array([fingerprint(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)),
                        pa.array(sig.view(np.int16).ravel())),
                ], ["doc_id", "text_hash", "n_shingles", "fp", "sig"])

    return map_batches(rows, work, f"doc_id {kind}, text_hash bigint, n_shingles bigint, "
                                   "fp binary, sig array<smallint>")


# -- the trees --------------------------------------------------------------------------------


def children(nodes: DataFrame, more: int) -> DataFrame:
    """One branching of (node, fp, tree, used, sig, ...); `more` of 1,000 nodes choose twice.

    `used` has a bit for each of the tree's functions chosen above the node.
    """
    free = f"filter(sequence(0, {OWN - 1}), c -> (shiftright(used, c) & 1) = 0)"
    place = "cast(pmod(xxhash64(node, 1), size(free)) as int)"
    other = "cast(pmod(place + 1 + pmod(xxhash64(node, 2), size(free) - 1), size(free)) as int)"
    chosen = (f"if(pmod(xxhash64(node, 3), 1000) < {more}, array(get(free, place), "
              f"get(free, {other})), array(get(free, place)))")
    return (nodes.selectExpr("*", f"{free} as free").selectExpr("*", f"{place} as place")
            .selectExpr("* except (node, free, place)", "node as parent", f"explode({chosen}) as c")
            .selectExpr(f"xxhash64(parent, c, get(sig, tree * {OWN} + c)) as node",
                        "used | shiftleft(1, c) as used", "* except (parent, c, used)"))


def sized(rows: DataFrame) -> DataFrame:
    """Rows of (node, fp) of nodes that hold more than one, with the node's size."""
    counts = rows.groupBy("node").agg(F.expr("count(*) as size")).filter("size > 1")
    return spread_join(rows, counts, ["node"], "size", "fp")


def branch(members: DataFrame, own: Plan) -> tuple[list[DataFrame], DataFrame | None]:
    """Leaves, and the nodes that are to be compared by blocks, as tables of (node, fp)."""
    rows = members.selectExpr(
        "fp", "sig", f"explode(sequence(0, {own.trees - 1})) as tree").selectExpr(
        "fp", "sig", "tree", "0 as used", "xxhash64(tree) as node", "cast(null as bigint) as above")
    for _ in range(LEAST_DEPTH):
        rows = children(rows, own.more)
    leaves: list[DataFrame] = []
    dense: list[DataFrame] = []
    depth = LEAST_DEPTH
    while True:
        level = land(sized(rows.select("node", "fp", "tree", "used", "above")), "nodes")
        leaves.append(level.filter(f"size <= {LEAF}").select("node", "fp"))
        large = level.filter(f"size > {LEAF}")
        # Every level that is branched has less than half the members per node of the one above.
        stuck = "2 * size > above" if depth < MOST_DEPTH else "true"
        if dense or not large.filter(stuck).isEmpty():
            dense.append(large.filter(stuck).select("node", "fp"))
        large = large.filter(f"not coalesce({stuck}, false)")
        if large.isEmpty():
            return leaves, reduce(DataFrame.unionByName, dense) if dense else None
        # A member is joined once, then goes to its nodes. Signatures of others are not shuffled.
        held = large.groupBy("fp").agg(
            F.expr("collect_list(struct(node, tree, used, size as above)) as nodes"))
        known = may_match(members.select("fp", "sig"), large, ["fp"], words_for(large.count()))
        rows = children(held.join(known, "fp").selectExpr("fp", "sig", "inline(nodes)"), own.deep)
        depth += 1


def distinct_groups(groups: DataFrame) -> DataFrame:
    """(node, fp) without groups that hold the same members as another one."""
    told = groups.groupBy("node").agg(F.expr("count(*) as n"), F.expr(
        "bit_xor(xxhash64(fp)) as a"), F.expr("sum(pmod(xxhash64(fp, 1), 4294967296)) as b"))
    one = told.groupBy("n", "a", "b").agg(F.expr("min(node) as node")).select("node")
    return groups.join(one, "node")


# -- comparing --------------------------------------------------------------------------------


def connected(pairs_a: np.ndarray, pairs_b: np.ndarray, n: int) -> np.ndarray:
    """The least member that each of n is connected with."""
    label = np.arange(n)
    while len(pairs_a):
        least = np.minimum(label[pairs_a], label[pairs_b])
        new = label.copy()
        np.minimum.at(new, pairs_a, least)
        np.minimum.at(new, pairs_b, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label


def clusters(groups: DataFrame, members: DataFrame, own_plan: Plan,
             known: DataFrame | None = None) -> DataFrame:
    """Cut (node, fp) into clusters by signature: (fps), a cluster's members in order, two at least.

    A cluster is one row however many members it has, and equal ones of several nodes are equal rows. With `known`, a table of (fp, root), pairs that already are in one component do not count.
    """
    # A member is joined once, then goes to its groups: some per tree, few for one that is let go.
    # Members without a group, most of them, are not shuffled.
    groups = land(groups, "groups")
    grouped = may_match(members.select("fp", "n_shingles", "sig"), groups, ["fp"],
                        words_for(groups.count())).selectExpr(
        "fp", "n_shingles", f"slice(sig, 1, {COORDINATES}) as sig")
    rows = groups.groupBy("fp").agg(F.expr("collect_list(node) as nodes")).join(grouped, "fp")
    own, similar, agree = "fp", own_plan.similar, own_plan.agree
    if known is not None:
        rows, own = rows.join(known, "fp", "left"), "coalesce(root, fp)"
    rows = rows.selectExpr("explode(nodes) as node", "fp", "n_shingles", "sig",
                           f"xxhash64({own}) as own")
    dealt = rows.repartition("node").sortWithinPartitions("node", "fp")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, "node"):
            node, fp, n, sig, own = batch.columns
            size, own = n.to_numpy(), own.to_numpy()
            sig = sig.flatten().to_numpy().reshape(-1, COORDINATES)
            cuts = group_cuts(node)
            count = np.diff(cuts)
            # Member i of a group is paired with each that follows it.
            after = np.repeat(cuts[1:], count) - np.arange(len(size)) - 1
            found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            ends = np.cumsum(after)
            for part in np.split(np.arange(len(size)), np.flatnonzero(np.diff(ends >> 14)) + 1):
                a = np.repeat(part, after[part])
                b = ragged(part + 1, after[part])
                ok = ((100 * np.minimum(size[a], size[b]) >= similar * np.maximum(size[a], size[b]))
                      & (own[a] != own[b]))
                a, b = a[ok], b[ok]
                ok = (sig[a] == sig[b]).sum(axis=1) >= agree
                found_a.append(a[ok])
                found_b.append(b[ok])
            label = connected(np.concatenate(found_a), np.concatenate(found_b), len(size))
            held = np.bincount(label, minlength=len(label))
            kept = np.flatnonzero(held[label] > 1)
            kept = kept[np.argsort(label[kept], kind="stable")]
            ends = np.concatenate([[0], np.cumsum(held[held > 1])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(ends), fp.take(pa.array(kept)))], ["fps"])

    return map_batches(dealt, work, "fps array<binary>")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(fp, shingles) of the wanted members, computed anew from the text of one copy."""
    wanted = land(wanted, "wanted")
    small = F.broadcast(wanted) if is_small(wanted) else wanted
    rows = pick(docs, "doc_id", "text").join(small, F.expr("doc_id <=> rep")).select("fp", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                sets = shingle_sets(step.column(1))
                # Another text may have the same doc_id.
                same = [i for i, (s, fp) in enumerate(zip(
                    sets, step.column(0).to_pylist(), strict=True)) if fingerprint(s) == fp]
                lengths = np.array([len(sets[i]) for i in same], np.int64)
                flat = np.concatenate([np.zeros(0, np.uint64), *(sets[i] for i in same)])
                yield pa.RecordBatch.from_arrays([
                    step.column(0).take(pa.array(same, pa.int64())),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)),
                        pa.array(flat.view(np.int64)))], ["fp", "shingles"])

    return map_batches(rows, work, "fp binary, shingles array<bigint>")


def linked(sets: list[np.ndarray], similar: int) -> np.ndarray:
    """Which of the sets are similar enough, by their exact intersections."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    distinct, place = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.zeros((len(sets), len(sets)), np.int64)
    width = 1 << 13
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    cuts = np.searchsorted(place, np.arange(0, len(distinct) + width, width))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        held = np.zeros((len(sets), width), np.float32)
        held[owner[a:b], place[a:b] - k * width] = 1
        shared += (held @ held.T).astype(np.int64)
    union = size[:, None] + size[None, :] - shared
    return 100 * shared >= similar * union


def links(found: DataFrame, members: DataFrame, docs: DataFrame, similar: int) -> DataFrame:
    """(u, v): a spanning forest of the confirmed links of every cluster of (fps)."""
    groups = land(found.distinct().selectExpr("xxhash64(fps) as node", "explode(fps) as fp"),
                  "clusters")
    wanted = groups.select("fp").distinct().join(members.select("fp", "rep"), "fp")
    dealt = (groups.join(full_sets(docs, wanted), "fp").select("node", "fp", "shingles")
             .repartition("node").sortWithinPartitions("node", "fp"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, "node"):
            cuts = group_cuts(batch.column(0))
            out_u, out_v = [], []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                fps = batch.column(1).slice(a, b - a).to_pylist()
                # Rows with one doc_id and one text bring a set more than once.
                first = [i for i, fp in enumerate(fps) if not i or fp != fps[i - 1]]
                lists = batch.column(2).slice(a, b - a)
                sets = [lists[i].values.to_numpy().view(np.uint64) for i in first]
                label = connected(*np.nonzero(np.triu(linked(sets, similar), 1)), len(sets))
                for i in np.flatnonzero(label != np.arange(len(sets))).tolist():
                    out_u.append(fps[first[i]])
                    out_v.append(fps[first[label[i]]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_u, pa.binary()), pa.array(out_v, pa.binary())], ["u", "v"])

    return land(map_batches(dealt, work, "u binary, v binary").distinct(), "links")


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) of all ends of (u, v), by alternating large-star and small-star steps."""
    told = None
    while True:
        both = edges.unionByName(edges.selectExpr("v as u", "u as v"))
        least = both.groupBy("u").agg(F.expr("least(u, min(v)) as m"), F.expr("count(*) as n"))
        large = spread_join(both, least, ["u"], "n", "v").filter("v > u").selectExpr(
            "v as u", "m as v").filter("u <> v").distinct()
        down = large.selectExpr("greatest(u, v) as u", "least(u, v) as v")
        least = down.groupBy("u").agg(F.expr("min(v) as m"), F.expr("count(*) as n"))
        small = spread_join(down, least, ["u"], "n", "v").selectExpr("v as u", "m as v").unionByName(
            least.selectExpr("u", "m as v")).filter("u <> v").distinct()
        edges = land(small, "stars")
        now = edges.selectExpr("count(*)", "bit_xor(xxhash64(u, v))").first()
        if now == told:
            return edges.selectExpr("u as fp", "v as root").unionByName(
                edges.selectExpr("v as fp", "v as root").distinct())
        told = now


def dense_blocks(large: DataFrame) -> DataFrame:
    """Random blocks of each large node, each with the node's first member, as (node, fp)."""
    facts = large.groupBy("node").agg(F.expr("count(*) as size"), F.expr("min(fp) as first"))
    rows = spread_join(large, facts, ["node"], "size", "fp")
    block = f"cast(pmod(xxhash64(fp, node), (size - 1) div {BLOCK} + 1) as bigint)"
    firsts = facts.selectExpr(
        f"explode(sequence(0L, (size - 1) div {BLOCK})) as block", "node", "first as fp")
    return rows.selectExpr(f"xxhash64(node, {block}) as node", "fp").unionByName(
        firsts.selectExpr("xxhash64(node, block) as node", "fp")).distinct()


def dense_rest(large: DataFrame, roots: DataFrame) -> DataFrame:
    """Every pair of a large node whose ends are not both in its largest component meets in a group."""
    rows = large.join(roots, "fp", "left").selectExpr("node", "fp", "coalesce(root, fp) as root")
    held = rows.groupBy("node", "root").agg(F.expr("count(*) as n"))
    facts = held.groupBy("node").agg(F.expr("max_by(root, struct(n, root)) as main"),
                                     F.expr("sum(n) as size"), F.expr("sum(n) - max(n) as others"))
    facts = facts.filter("others > 0")
    rows = spread_join(rows, facts, ["node"], "size", "fp")
    blocks, portions = f"(size - 1) div {BLOCK} + 1", f"(others - 1) div {BLOCK} + 1"
    own = (f"transform(sequence(0L, {portions} - 1), j -> "
           f"xxhash64(node, pmod(xxhash64(fp, node), {blocks}), j))")
    across = (f"transform(sequence(0L, {blocks} - 1), i -> "
              f"xxhash64(node, i, pmod(xxhash64(fp, node, 1), {portions})))")
    return rows.selectExpr("fp", f"explode({own}) as node").unionByName(
        rows.filter("root <> main").selectExpr("fp", f"explode({across}) as node")).distinct()


def near_duplicates(docs: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and text_hash, a hash of the text, of every document.

    `similar` is the least similarity of a link in percent.
    """
    own = plan(similar)
    signed = land(signatures(docs, own), "signatures")
    members = land(
        signed.filter("fp is not null").groupBy("fp").agg(
            F.expr("min(doc_id) as rep"), F.expr("count(*) as copies"),
            F.expr("any_value(n_shingles) as n_shingles"), F.expr("any_value(sig) as sig")),
        "members")
    leaves, large = branch(members, own)
    groups = leaves[0]
    for more in leaves[1:]:
        groups = groups.unionByName(more)
    groups = distinct_groups(groups)
    if large is not None:
        # Blocks of distinct nodes are cut by different hashes, so hardly any two are equal.
        large = land(distinct_groups(large), "large")
        groups = groups.unionByName(dense_blocks(large))
    edges = links(clusters(groups, members, own), members, docs, own.similar)
    roots = land(components(edges), "roots")
    if large is not None:
        rest = clusters(dense_rest(large, roots), members, own, roots)
        edges = edges.unionByName(links(rest, members, docs, own.similar))
        roots = land(components(edges), "roots")
    named = members.join(roots, "fp", "left").selectExpr(
        "fp", "copies", "rep", "coalesce(root, fp) as root")
    least = named.groupBy("root").agg(F.expr("min(rep) as component_id"), F.expr("count(*) as n"))
    facts = spread_join(named, least, ["root"], "n", "fp").select("fp", "copies", "component_id")
    narrow = signed.select("doc_id", "n_shingles", "fp", "text_hash")
    joined = spread_join(narrow.filter("fp is not null"), facts, ["fp"], "copies", "doc_id")
    return joined.selectExpr(
        "doc_id", "n_shingles", "component_id", "doc_id <=> component_id as kept", "text_hash"
    ).unionByName(narrow.filter("fp is null").selectExpr(
        "doc_id", "n_shingles", "doc_id as component_id", "true as kept", "text_hash"))


def deduplicated(docs: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """All columns of the documents that stay: one of each component, one of repeated rows."""
    kept = near_duplicates(docs, similar).filter("kept").selectExpr(
        "doc_id as kept_id", "text_hash as kept_hash").distinct()
    columns = [f"_{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*columns)
    key = columns[docs.columns.index("doc_id")]
    text = columns[docs.columns.index("text")]
    return (plain.withColumn("own_hash", F.xxhash64(text))
            .join(kept, F.expr(f"{key} <=> kept_id and own_hash = kept_hash"))
            .dropDuplicates(["kept_id", "kept_hash"]).select(*columns).toDF(*docs.columns))

"""Operator 13: documents are packed into sequences of at most `limit` tokens by linear grouping.

A document is its ids and one end id. Only a document longer than a sequence is cut, into pieces of
`limit` tokens; its last piece may be shorter. Pieces are known by their length, of which there are
at most `limit`, so what the packing is planned from is a table of that many counts, whatever the
number of documents. The plan has four steps:

1. Large lengths, above a share of the limit, are laid out from the longest to the shortest and cut into
   GROUPS groups of equal cardinality; the lengths of a group are rounded up to its longest.
2. With these few sizes, the linear program over the ways to fill a sequence is solved by generating
   columns; each way is used as often as the solution says, rounded down.
3. Actual pieces take the places of the rounded ones, the longest first, so every sequence has at
   least the room that the program left.
4. What rounding down left over and all small lengths, from the longest, go where they fit best, into
   the fullest sequence that has room; a new sequence is opened only if none has.

The plan is made for each of the shares SMALL, and the one of the fewest sequences is taken: where large
lengths have little to fill their gaps, rounding them up costs more than it brings.

Sequences of equal room are handled together as runs of numbers, so the plan has a few thousand
entries and each is "pieces of this length and these ranks take these sequences from this offset".
The rank of a piece among those of its length is its place in its task, counted while tokenizing, plus
the pieces of that length in earlier tasks. Nothing meets in one task but counts, also if a third of
all documents have one length.

Null text is empty; a document without ids is its end id alone, in a sequence like all others. Texts of
any length are tokenized whole, by distinct words. Repeated rows and ids are documents of their own.
Which of two pieces of one length takes which place depends on the order of reading; the lengths of
all sequences do not. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitwise.llm.common import land, map_batches, pick, ragged, steps, texts_of
from remitwise.llm.memo import Coder, cut_at, file_coder, per_text

LIMIT, END_ID = 2048, 0
# Groups of large lengths, and the shares of a sequence up to which a length may count as small.
GROUPS, SMALL = 64, (2, 4, 8, 16)
# The program counts as solved when its bound is as near as this.
NEAR, MOST_COLUMNS = 1e-4, 3000

# Special strings of the vocabulary, which the library finds in texts before anything else.
SPECIAL = r"(?i)<\|(?:start|end)oftext\|>"

_CODERS: dict[str, Coder] = {}

# Kinds of bytes: white space, letters, digits, other ASCII, and the parts of other characters.
_KIND = np.full(256, 4)
_KIND[:128] = 3
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2


def coder(path: str) -> Coder:
    if path not in _CODERS:
        _CODERS[path] = file_coder(path, plain=False)
    return _CODERS[path]


def document_ids(column: pa.Array, path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts with an end id after each, and the offsets of the texts in them.

    The vocabulary has no token over white space, lower-cases, and parts letters, single digits and
    other signs, but for an apostrophe and what follows it; so texts are cut there. A text with a
    special string is cut at white space only.
    """
    special = pc.fill_null(pc.match_substring_regex(column, SPECIAL), False).to_numpy(
        zero_copy_only=False)
    data, offsets = texts_of(column)
    kind = _KIND[data]
    before, after = kind[:-1], kind[1:]
    starts = np.ones(len(data), bool)
    starts[1:] = (after == 0) != (before == 0)
    fine = ((before != after) & (before > 0) & (after < 4) & (before < 4) & (data[:-1] != 39)
            | (before == 2) & (after == 2))
    lower = (data >= 65) & (data <= 90)
    if special.any():
        plain = np.repeat(~special, np.diff(offsets))
        fine &= plain[1:]
        lower &= plain
    starts[1:] |= fine
    cuts = cut_at(starts, offsets)
    flat, sizes = coder(path).codes(np.where(lower, data + 32, data).astype(np.uint8), cuts)
    ends = per_text(sizes, cuts, offsets)
    return np.insert(flat, ends[1:], end_id), ends + np.arange(len(ends))


def places_within(values: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """How often each value came before; `seen` counts the values of earlier calls and goes on."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.searchsorted(ordered, ordered)
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - first + seen[ordered]
    np.add.at(seen, values, 1)
    return out


def pieces(docs: DataFrame, path: str, limit: int = LIMIT, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and (part, place): the piece is the place-th of its
    length in its task. To be written before use, since tasks that run again may count anew."""
    rows = pick(docs, "doc_id", "text")
    kind = rows.schema[0].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, part = np.zeros(limit + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            for step in steps(batch, "text"):
                ids, offsets = document_ids(step.column(1), path, end_id)
                total = np.diff(offsets)
                count = -(-total // limit)
                doc = np.repeat(np.arange(len(total)), count)
                number = ragged(np.zeros(len(count), np.int64), count)
                start = number * limit
                length = np.minimum(limit, total[doc] - start)
                begin = offsets[:-1][doc] + start
                data = ids.astype("<u4")
                crc = [zlib.crc32(data[a:b]) for a, b in zip(begin, begin + length, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [step.column(0).take(pa.array(doc)), pa.array(number.astype(np.int32)),
                     pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                     pa.array(np.full(len(doc), part, np.int32)),
                     pa.array(places_within(length, seen))],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"])

    return map_batches(rows, work, f"doc_id {kind}, piece int, start bigint, length bigint, "
                                   "ids_crc32 bigint, part int, place bigint")


# -- the plan ---------------------------------------------------------------------------------


def grouped(lengths: np.ndarray, counts: np.ndarray, groups: int) -> list[list[list[int]]]:
    """Groups of equal cardinality, as runs [length, pieces], from the longest lengths on.

    Groups of one longest length are one group.
    """
    ends = np.cumsum(counts)
    out: list[list[list[int]]] = []
    last = -1
    for length, end, count in zip(lengths, ends, counts, strict=True):
        at = end - count
        while at < end:
            group = int(at * groups // ends[-1])
            upto = min(end, -(-(group + 1) * ends[-1] // groups))
            if group != last and not (out and out[-1][0][0] == length):
                out.append([])
            last = group
            out[-1].append([int(length), int(upto - at)])
            at = upto
    return out


def fullest(sizes: np.ndarray, worth: np.ndarray, limit: int) -> tuple[float, np.ndarray]:
    """The way to fill a sequence that is worth most: its worth, and how many it has of each size."""
    best, choice = np.zeros(limit + 1), np.full(limit + 1, -1)
    for g, (size, gain) in enumerate(zip(sizes, worth, strict=True)):
        if gain <= 0:
            continue
        for _ in range(limit // size):
            other = best[:-size] + gain
            better = other > best[size:] + 1e-12
            if not better.any():
                break
            best[size:][better] = other[better]
            choice[size:][better] = g
    column, room = np.zeros(len(sizes)), int(best.argmax())
    while choice[room] >= 0:
        column[choice[room]] += 1
        room -= sizes[choice[room]]
    return float(best.max()), column


def fillings(sizes: np.ndarray, demand: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(ways to fill, how often): a near-optimal solution of the linear program of few sizes.

    Simplex steps on a basis that begins with one size per way; a new way comes from the duals.
    """
    n = len(sizes)
    basis = np.diag((limit // sizes).astype(float))
    cost = np.ones(n)
    for _ in range(MOST_COLUMNS):
        inverse = np.linalg.inv(basis)
        amount, dual = inverse @ demand, cost @ inverse
        if dual.min() < -1e-9:  # more than was asked for is allowed
            column, price = np.zeros(n), 0.0
            column[dual.argmin()] = -1
        else:
            worth, column = fullest(sizes, dual, limit)
            price = 1.0
            if worth <= 1 + NEAR:
                break
        change = inverse @ column
        rising = change > 1e-9
        if not rising.any():
            break
        ratio = np.where(rising, np.maximum(amount, 0) / np.where(rising, change, 1), np.inf)
        leave = int(ratio.argmin())
        basis[:, leave], cost[leave] = column, price
    amount = np.linalg.inv(basis) @ demand
    used = (cost > 0) & (amount > 0)
    return basis[:, used].T.astype(np.int64), amount[used]


class Plan:
    """Entries (length, rank, pieces, sequence, pieces per sequence, offset), made run by run."""

    def __init__(self, limit: int):
        self.limit, self.sequences = limit, 0
        self.entries: list[tuple[int, int, int, int, int, int]] = []
        self.ranks = [0] * (limit + 1)
        # Runs [first sequence, number] of sequences, by the room that they have.
        self.room: list[list[tuple[int, int]]] = [[] for _ in range(limit + 1)]
        self.any = np.zeros(limit + 1, bool)

    def put(self, length: int, first: int, number: int, each: int, room: int) -> None:
        """`each` pieces of a length into each of `number` sequences that have `room`."""
        self.entries.append((length, self.ranks[length], number * each, first, each,
                             self.limit - room))
        self.ranks[length] += number * each

    def keep(self, first: int, number: int, room: int) -> None:
        if number:
            self.room[room].append((first, number))
            self.any[room] = True

    def fill(self, way: np.ndarray, number: int, queues: list[list[list[int]]]) -> None:
        """`number` new sequences filled one way, with the next pieces of its groups."""
        runs = [(self.sequences, number, self.limit)]
        self.sequences += number
        for group in np.flatnonzero(way):
            for _ in range(way[group]):
                after = []
                for first, n, room in runs:
                    while n and queues[group]:
                        head = queues[group][0]
                        some = min(n, head[1])
                        self.put(head[0], first, some, 1, room)
                        after.append((first, some, room - head[0]))
                        first, n = first + some, n - some
                        head[1] -= some
                        if not head[1]:
                            queues[group].pop(0)
                    if n:
                        after.append((first, n, room))
                runs = after
        for first, n, room in runs:
            self.keep(first, n, room)

    def best_fit(self, length: int, count: int) -> None:
        """Pieces of one length into the fullest sequences with room; new ones after that."""
        while count:
            room = length + int(self.any[length:].argmax())
            if not self.any[room]:
                room = self.limit
                first, number = self.sequences, -(-count // (room // length))
                self.sequences += number
            else:
                first, number = self.room[room].pop()
                self.any[room] = bool(self.room[room])
            each = room // length
            full = min(number, count // each)
            if full:
                self.put(length, first, full, each, room)
                self.keep(first, full, room - each * length)
                count -= full * each
            if full < number:
                if count:
                    self.put(length, first + full, 1, count, room)
                    self.keep(first + full, 1, room - count * length)
                    full, count = full + 1, 0
                self.keep(first + full, number - full, room)


def plan(histogram: dict[int, int], limit: int = LIMIT, groups: int = GROUPS,
         small: tuple[int, ...] = SMALL) -> tuple[np.ndarray, int]:
    """(entries sorted by length and rank, number of sequences) for so many pieces of each length.

    The best of the plans that take lengths above limit / s as large, for each s of `small`.
    """
    best = min((one_plan(histogram, limit, groups, s) for s in small), key=lambda p: p.sequences)
    entries = np.array(best.entries, np.int64).reshape(-1, 6)
    return entries[np.lexsort((entries[:, 1], entries[:, 0]))], best.sequences


def one_plan(histogram: dict[int, int], limit: int, groups: int, small: int) -> Plan:
    out = Plan(limit)
    lengths = np.array(sorted(histogram, reverse=True), np.int64)
    counts = np.array([histogram[int(n)] for n in lengths], np.int64)
    large = (lengths * small > limit) & (lengths < limit)
    rest = {int(n): int(c) for n, c in zip(lengths[~large], counts[~large], strict=True)}
    if large.any():
        queues = grouped(lengths[large], counts[large], groups)
        sizes = np.array([q[0][0] for q in queues])
        demand = np.array([sum(c for _, c in q) for q in queues], float)
        ways, often = fillings(sizes, demand, limit)
        for way, number in zip(ways, np.floor(often + 1e-6).astype(np.int64), strict=True):
            if number:
                out.fill(way, int(number), queues)
        for length, count in (run for q in queues for run in q):
            rest[length] = rest.get(length, 0) + count
    for length in sorted(rest, reverse=True):
        out.best_fit(length, rest[length])
    return out


def packed(docs: DataFrame, path: str, limit: int = LIMIT, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece and its place."""
    rows = land(pieces(docs, path, limit, end_id), "pieces")
    counted = land(rows.groupBy("part", "length").agg(F.expr("count(*) as n")), "piece_counts")
    # At most `limit` rows.
    histogram = dict(map(tuple, counted.groupBy("length").agg(F.expr("sum(n) as n")).collect()))
    entries, _ = plan(histogram, limit)
    # As many rows per length as there are tasks.
    before = counted.selectExpr("part as _part", "length as _length",
                                "sum(n) over (partition by length order by part) - n as _before")
    ranked = rows.join(before, F.expr("part = _part and length = _length")).selectExpr(
        "doc_id", "piece", "start", "length", "ids_crc32", "_before + place as place")
    kind = rows.schema[0].dataType.simpleString()
    key = entries[:, 0] << 48 | entries[:, 1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            entry = entries[np.searchsorted(key, length << 48 | rank, "right") - 1]
            sequence, slot = np.divmod(rank - entry[:, 1], entry[:, 4])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(entry[:, 3] + sequence),
                 pa.array(entry[:, 5] + slot * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return map_batches(ranked, work, f"doc_id {kind}, piece int, start bigint, length bigint, "
                                     "ids_crc32 bigint, sequence_id bigint, offset bigint")

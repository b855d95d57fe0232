"""Operator 12: the tokens of two tokenizers over the same bytes, aligned.

Both tokenizers spell the text with a blank before it. Their token ends cut it into groups at the
bytes where a token of each ends, and every pair of tokens whose bytes overlap is a link. All texts
of a batch are merged in lockstep: one vector holds a pointer into A and one into B for every lane, and
each step emits the link that each lane points at, advances whichever token ends first, both where they
end together (a cut), and drops the lanes that are done. A text of more than LANE tokens is several
lanes, so that one long text does not keep the others waiting.

How often a pair of ids is linked in all documents is counted through the distinct pairs of parts,
runs of texts of bounded size: a part's pairs and counts are one row, summed over all parts, and what
comes back to a part is the sum for each of its pairs, not for each link. A document's links wait as
numbers of pairs within its part, sorted, as the byte-sized steps between them.

Texts that are null or empty, or that either tokenizer does not spell byte for byte, have no tokens:
zeros and an empty digest. Texts of any length are aligned whole. Repeated rows and ids are documents of
their own, and each counts. Extra columns are ignored; an empty table gives no rows. Equally frequent
pairs of a B id are all its best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitwise.llm.common import land, map_batches, pick, ragged, ship, steps, texts_of
from remitwise.llm.memo import Coder, Merges, cut_at, file_coder, file_tokenizer, per_text, spelled
from remitwise.operators.skew import spread_join

# Tokens of A in one lane, and bytes of text after which a part ends.
LANE, PART_BYTES = 256, 16 << 20
# Steps from which on a number is written apart.
FAR = 255

_KIND = np.full(256, 4)  # parts of characters beyond ASCII
_KIND[:128] = 3
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2


def spaced(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts with a blank before each, and the offsets of the texts in them."""
    column = pc.fill_null(column.cast(pa.string()), "")
    return texts_of(pc.binary_join_element_wise("", column, " "))


class Side:
    """One tokenizer: the ids of texts, and the bytes of each id."""

    def __init__(self, coder: Coder, spelling: list[bytes]):
        self.coder = coder
        self.size = np.fromiter(map(len, spelling), np.int64, len(spelling))
        self.spelling = pa.array(spelling, pa.large_binary())

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, offsets of the texts among them, which texts the ids spell byte for byte)."""
        cuts = self.cuts(data, offsets)
        ids, sizes = self.coder.codes(data, cuts)
        ends = per_text(sizes, cuts, offsets)
        said, upto = spelled(self.spelling, ids)
        upto = upto[ends]
        if np.array_equal(said, data) and np.array_equal(upto, offsets):
            return ids, ends, np.ones(len(offsets) - 1, bool)
        same = [np.array_equal(said[a:b], data[c:d]) for a, b, c, d in zip(
            upto[:-1], upto[1:], offsets[:-1], offsets[1:], strict=True)]
        return ids, ends, np.array(same, bool)


class Bytes(Side):
    """A byte-level vocabulary file; special strings are ordinary text."""

    def __init__(self, path: str):
        # Byte-level vocabularies write bytes that do not print as the characters from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown}
        byte.update((chr(256 + i), b) for i, b in enumerate(sorted(set(range(256)) - set(shown))))
        vocab = file_tokenizer(path, plain=True).get_vocab(with_added_tokens=True)
        spelling = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            spelling[i] = bytes(byte[c] for c in token)
        super().__init__(file_coder(path, plain=True), spelling)

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A blank begins a word unless white space is before it; letters, digits and other signs
        part from each other, but for a blank and an apostrophe and what follows them."""
        kind = _KIND[data]
        before, after = kind[:-1], kind[1:]
        starts = np.zeros(len(data), bool)
        apart = (before != after) & (before > 0) & (data[:-1] != 39)
        starts[1:] = apart & (after > 0) & (after < 4) & (before < 4)
        blank = (data[1:] == 32) & (before > 0)
        # White space beyond ASCII ends in one of these bytes.
        blank &= (before < 4) | ~np.isin(data[:-1], [0x80, 0x81, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87,
                                                     0x88, 0x89, 0x8A, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF])
        starts[1:] |= blank
        return cut_at(starts, offsets)


class Pieces(Side):
    """A model of the sentencepiece library."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [library.id_to_piece(i) for i in range(library.get_piece_size())]
        mark = library.piece_to_id("▁")
        spelling = [bytes([int(p[3:5], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode()
                    for i, p in enumerate(pieces)]
        # No piece goes on behind a blank, so a blank after something else begins a word.
        self.parted = not any("▁" in p.lstrip("▁") for p in pieces)

        def encode(words: list[str]) -> list[list[int]]:
            # The library adds the first blank, but not to an empty text.
            return [ids or [mark] for ids in library.encode([w[1:] for w in words], num_threads=1)]

        merges = Merges.of_pieces(pieces, [library.get_score(i) for i in range(len(pieces))])
        super().__init__(Coder(merges, encode), spelling)

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        starts = np.zeros(len(data), bool)
        starts[1:] = (data[1:] == 32) & (data[:-1] != 32) & self.parted
        return cut_at(starts, offsets)


_SIDES: dict[tuple, Side] = {}
_DECIMALS: dict[int, pa.Array] = {}


def decimal_table(most: int) -> pa.Array:
    if most not in _DECIMALS:
        _DECIMALS[most] = decimals(most)
    return _DECIMALS[most]


def side(kind: type[Side], path: str) -> Side:
    if (kind, path) not in _SIDES:
        _SIDES[kind, path] = kind(path)
    return _SIDES[kind, path]


def lockstep(end_a: np.ndarray, end_b: np.ndarray, i: np.ndarray, j: np.ndarray, stop: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(A and B place of every link, A and B place before every cut), in no particular order.

    `end_a` and `end_b` are the ends of the tokens among the bytes of all texts; a lane goes from
    the A token `i`, where it meets the B token `j`, to the A token before `stop`.
    """
    links, cuts = ([], []), ([], [])
    while len(i):
        a, b = end_a[i], end_b[j]
        links[0].append(i)
        links[1].append(j)
        both = a == b
        cuts[0].append(i[both])
        cuts[1].append(j[both])
        i, j = i + (a <= b), j + (b <= a)
        live = i < stop
        if not live.all():
            i, j, stop = i[live], j[live], stop[live]
    none = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(x or none) for x in (*links, *cuts))


def decimals(most: int) -> pa.Array:
    """Every id below `most` in decimal digits with each of the marks behind it, at 3 * id + mark."""
    return pa.array([b"%d%s" % (i, m) for i in range(most) for m in (b",", b"|", b";")],
                    pa.large_binary())


def align(column: pa.Array, a: Side, b: Side) -> dict[str, np.ndarray | list[str]]:
    """Counts and digest of each text, and (text, A id, B id) of every link of the batch."""
    data, offsets = spaced(column)
    ids_a, ends_a, fine = a.ids(data, offsets)
    ids_b, ends_b, fine_b = b.ids(data, offsets)
    fine &= fine_b & (np.diff(offsets) > 1)
    texts = np.flatnonzero(fine)
    n_a, n_b = (np.where(fine, np.diff(e), 0) for e in (ends_a, ends_b))
    ids_a = ids_a[ragged(ends_a[:-1][fine], n_a[fine])]
    ids_b = ids_b[ragged(ends_b[:-1][fine], n_b[fine])]
    text_a = np.repeat(texts, n_a[fine])
    first_a, first_b = (np.cumsum(n[fine]) - n[fine] for n in (n_a, n_b))
    end_a, end_b = np.cumsum(a.size[ids_a]), np.cumsum(b.size[ids_b])
    # Lanes of at most LANE tokens of A.
    count = -(-n_a[fine] // LANE)
    number = ragged(np.zeros(len(count), np.int64), count)
    i = np.repeat(first_a, count) + number * LANE
    stop = np.minimum(i + LANE, np.repeat(first_a + n_a[fine], count))
    j = np.searchsorted(end_b, end_a[i] - a.size[ids_a[i]], "right")
    link_a, link_b, cut_a, cut_b = lockstep(end_a, end_b, i, j, stop)
    cut_a, cut_b = np.sort(cut_a), np.sort(cut_b)
    ends_group_a, ends_group_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    ends_group_a[cut_a], ends_group_b[cut_b] = True, True
    # Each group: its A tokens, then its B tokens.
    group_a = np.cumsum(ends_group_a) - ends_group_a
    group_b = np.cumsum(ends_group_b) - ends_group_b
    b_before = np.concatenate([[0], cut_b + 1])
    order = np.empty(len(ids_a) + len(ids_b), np.int64)
    at_a = np.arange(len(ids_a)) + b_before[group_a]
    at_b = np.arange(len(ids_b)) + cut_a[group_b] + 1
    order[at_a] = ids_a.astype(np.int64) * 3 + ends_group_a
    order[at_b] = ids_b.astype(np.int64) * 3 + 2 * ends_group_b
    said, place = spelled(decimal_table(max(len(a.size), len(b.size))), order)
    # Without the mark behind the last group of a text.
    last = place[first_a + first_b + n_a[fine] + n_b[fine]] - 1
    said = np.delete(said, last)
    upto = np.zeros(len(fine) + 1, np.int64)
    upto[texts + 1] = np.diff(place[np.append(first_a + first_b, len(order))]) - 1
    groups = pa.Array.from_buffers(pa.string(), len(fine), [
        None, pa.py_buffer(np.cumsum(upto).astype(np.int32)), pa.py_buffer(said)])
    return {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(text_a[cut_a], minlength=len(fine)),
            "n_links": np.bincount(text_a[link_a], minlength=len(fine)), "groups": groups,
            "text": text_a[link_a], "pair": ids_a[link_a].astype(np.int64) << 32 | ids_b[link_b]}


def gaps(text: np.ndarray, number: np.ndarray, count: int) -> tuple[pa.Array, pa.Array]:
    """The numbers of each text in ascending order, as the steps between them: a byte each, and
    the steps of FAR or more, which have this byte, apart."""
    order = np.argsort(text << 32 | number, kind="stable")
    text, number = text[order], number[order]
    step = np.diff(number, prepend=0)
    first = np.ones(len(text), bool)
    first[1:] = text[1:] != text[:-1]
    step[first] = number[first]
    ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=count))])
    wide = step >= FAR
    far = 4 * np.concatenate([[0], np.cumsum(wide)])[ends]
    return (binary(np.minimum(step, FAR).astype(np.uint8), ends),
            binary(step[wide].astype("<u4").view(np.uint8), far))


def binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
        None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def numbers(near: pa.Array, far: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, offsets of the texts in them) from `gaps`."""
    step, far = (np.frombuffer(b"".join(c.to_pylist()), t) for c, t in ((near, np.uint8), (far, "<u4")))
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(near).to_numpy())]).astype(np.int64)
    step = step.astype(np.int64)
    step[step == FAR] = far
    upto = np.concatenate([[0], np.cumsum(step)])
    return upto[1:] - np.repeat(upto[ends[:-1]], np.diff(ends)), ends


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def linked(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, the counts, groups, and the links of each text as numbers of pairs of its part.

    A row without counts holds the pairs and how often the part has each. To be written before
    use, since tasks that run again may cut other parts.
    """
    rows = pick(docs, "doc_id", "text")
    kind = rows.schema[0].dataType
    schema = (f"part bigint, doc_id {kind.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, "
              "n_links bigint, groups string, near binary, far binary, pairs array<bigint>, "
              "times array<bigint>")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = side(Bytes, path_a), side(Pieces, path_b)
        part, size = TaskContext.get().partitionId() << 32, 0
        pairs, times = pa.array([], pa.int64()), np.zeros(0, np.int64)

        def row_of_pairs(id_type: pa.DataType) -> pa.RecordBatch:
            n = len(pairs)
            lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), x)
                     for x in (pairs, pa.array(times))]
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.nulls(1, id_type), *[pa.nulls(1, pa.int64())] * 4,
                 pa.nulls(1, pa.string()), *[pa.nulls(1, pa.binary())] * 2, *lists], names)

        names = ["part", "doc_id", *COUNTS, "groups", "near", "far", "pairs", "times"]
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for step in steps(batch, "text"):
                n = step.num_rows
                got = align(step.column(1), a, b)
                # Numbers go on from those that the part has already.
                coded = pa.chunked_array([pairs, pa.array(got["pair"])]).dictionary_encode()
                coded = coded.combine_chunks()
                number = coded.indices.to_numpy()[len(pairs):].astype(np.int64)
                pairs = coded.dictionary
                count = np.bincount(number, minlength=len(pairs))
                count[:len(times)] += times
                times = count
                near, far = gaps(got["text"], number, n)
                none = pa.nulls(n, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part)), step.column(0), *(pa.array(got[c]) for c in COUNTS),
                     got["groups"], near, far, none, none], names)
                size += step.column(1).nbytes
                if size >= PART_BYTES:
                    yield row_of_pairs(id_type)
                    part, size, pairs, times = part + 1, 0, pairs[:0], times[:0]
        if size:
            yield row_of_pairs(id_type)

    return map_batches(rows, work, schema)


def pair_counts(parts: DataFrame) -> DataFrame:
    """(of_part, number, total, best): in all documents, how often the pair of this number of the part
    is linked, and whether no pair of its B id is linked more often. `parts` is `linked`, written."""
    said = parts.filter("pairs is not null").selectExpr(
        "part", "posexplode(arrays_zip(pairs, times)) as (number, p)").selectExpr(
        "part", "number", "p.pairs as pair", "p.times as n")
    # As many rows per B id as it has A ids: bounded by the vocabulary.
    total = said.groupBy("pair").agg(F.expr("sum(n) as total"), F.expr("count(*) as parts"))
    facts = total.selectExpr("*", "total = max(total) over (partition by pair & 4294967295) as best")
    return spread_join(said, facts, ["pair"], "parts", "part").selectExpr(
        "part as of_part", "number", "total", "best")


def aligned(docs: DataFrame, path_a: str, path_b: str, keep: tuple[str, ...] = ("groups",)
            ) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, and `keep`: expressions over groups,
    `a1,a2|b1;a3|b2` with the decimal ids of each group's A and B tokens, and the counts."""
    rows = linked(docs, path_a, path_b).selectExpr(
        "part", "doc_id", *COUNTS, "near", "far", "pairs", "times", *keep)
    rows = land(rows, "aligned")
    texts = rows.filter("pairs is null").drop("pairs", "times")
    others = [f for f in texts.schema if f.name not in ("part", "near", "far")]

    def counted(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        total, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        place = right.column("number").to_numpy()
        total[place] = right.column("total").to_numpy()
        best[place] = right.column("best").to_numpy()
        number, ends = numbers(*(left.column(c).combine_chunks() if left.num_rows else
                                 pa.array([], pa.binary()) for c in ("near", "far")))
        sums = [np.diff(np.concatenate([[0], np.cumsum(x[number])])[ends]) for x in (best, total)]
        return pa.table([*(left.column(f.name) for f in others), *map(pa.array, sums)],
                        [*(f.name for f in others), "n_best", "count_sum"])

    ship(docs.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return texts.groupBy("part").cogroup(pair_counts(rows).groupBy("of_part")).applyInArrow(
        counted, f"{schema}, n_best bigint, count_sum bigint").select(
        "doc_id", *COUNTS, "n_best", "count_sum", *[f.name for f in others[5:]])

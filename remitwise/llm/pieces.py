"""Operator 3: SentencePiece encoding and decoding for merge-type vocabularies.

Encoding keeps, for each text, an agenda of adjacent symbol pairs that form a vocabulary piece. The
best-scored pair (leftmost of equals) is merged, its two neighbours enter the agenda, until it is
empty; symbols outside the vocabulary become byte pieces. Two facts make this columnar:

- no piece holds a word mark after another character, so words are independent: a batch is cut into
  words, and only the distinct ones that the process has not met are encoded;
- the agendas of all new words of a batch advance together, one merge each per round, in numpy.

Every new word is held against the sentencepiece library in the batch that brings it
(`verify=True`); a difference raises. Memory is bounded by the step size and `MEMO_WORDS`.

Nulls and empty texts have no ids and decode to the empty text. Repeated rows and extra columns do
not matter: results depend on the text alone. The vocabulary path is a parameter.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitwise.llm.common import PairTable, map_batches, pick, ragged, runs, steps, texts_of

MARK = "▁"
NEVER = np.int32(2**31 - 1)
# Words whose ids a process keeps; beyond that it starts anew.
MEMO_WORDS = 250_000
# Longer words take the scalar agenda, whose cost is n log n.
BLOCK_WORD = 48


class Vocabulary:
    """Pieces, scores and merges of a model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = pb.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        rules, kind = model.normalizer_spec, pb.ModelProto.SentencePiece
        if (model.trainer_spec.model_type != pb.TrainerSpec.BPE or rules.precompiled_charsmap
                or rules.remove_extra_whitespaces or not rules.add_dummy_prefix
                or not rules.escape_whitespaces or not model.trainer_spec.byte_fallback
                or model.trainer_spec.treat_whitespace_as_suffix
                or any(p.type == kind.USER_DEFINED for p in model.pieces)):
            raise ValueError("not a merge-type vocabulary with byte pieces and plain text rules")
        self.pieces = [p.piece for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces)
                    if p.type in (kind.NORMAL, kind.UNUSED)}
        self.scores = {i: model.pieces[i].score for i in self.ids.values()}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece spans words")
        self.byte_ids = np.zeros(256, np.int32)
        for i, p in enumerate(model.pieces):
            if p.type == kind.BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
        # Order of merging: equal scores share a rank.
        order = {s: r for r, s in enumerate(sorted(set(self.scores.values()), reverse=True))}
        self.rank = np.full(len(self.pieces) + 1, NEVER, np.int32)
        for i, s in self.scores.items():
            self.rank[i] = order[s]
        splits = [(self.ids[p[:k]], self.ids[p[k:]], i) for p, i in self.ids.items()
                  for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids]
        left, right, whole = (np.array(x) for x in zip(*splits, strict=True))
        self.merges = PairTable(self.key(left, right), whole)
        # What a piece decodes to: bytes, and where they lie.
        shown = [bytes([int(p[1:-1], 16)]) if k == kind.BYTE else b"" if k == kind.CONTROL
                 else model.trainer_spec.unk_surface.encode() if k == kind.UNKNOWN
                 else p.replace(MARK, " ").encode()
                 for p, k in zip(self.pieces, self.kinds, strict=True)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_length = np.array([len(s) for s in shown])
        self.shown_start = np.cumsum(self.shown_length) - self.shown_length
        self.is_byte = np.array([k == kind.BYTE for k in self.kinds])
        self.is_text = np.array([k in (kind.NORMAL, kind.UNUSED) for k in self.kinds])
        self.forget()

    @staticmethod
    def key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Key of a pair; symbols outside the vocabulary are negative and match nothing."""
        return (left.astype(np.uint64) << np.uint64(32)) | (
            right.astype(np.uint64) & np.uint64(0xFFFFFFFF))

    def forget(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.flat: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []

    # -- encoding ----------------------------------------------------------------------------

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole = self.merges.find(self.key(left, right))
        return whole, self.rank[whole]  # rank[-1] is NEVER

    def agenda(self, word: str) -> list[int]:
        """One word by a heap; -1 - code point stands for a symbol outside the vocabulary."""
        symbols = [self.ids.get(c, -1 - ord(c)) for c in word]
        before = list(range(-1, len(symbols) - 1))
        after = list(range(1, len(symbols) + 1))
        after[-1] = -1
        alive = [True] * len(symbols)
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and symbols[i] >= 0 and symbols[j] >= 0:
                whole = self.ids.get(self.pieces[symbols[i]] + self.pieces[symbols[j]])
                if whole is not None:
                    heapq.heappush(heap, (int(self.rank[whole]), i, symbols[i], symbols[j], whole))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while heap:
            _, i, left, right, whole = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or symbols[i] != left or j < 0 or symbols[j] != right:
                continue
            symbols[i], alive[j], after[i] = whole, False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [s for s, a in zip(symbols, alive, strict=True) if a]

    def agendas(self, words: list[str], width: int) -> np.ndarray:
        """The agendas of words of at most `width` characters, one merge each per round."""
        text = "".join(words)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        distinct, place = np.unique(points, return_inverse=True)
        known = np.array([self.ids.get(chr(c), -1 - c) for c in distinct.tolist()], np.int64)
        count = np.fromiter(map(len, words), np.int64, len(words))
        gap = np.int64(-(1 << 31))
        out = np.full((len(words), width), gap)
        out[np.arange(width) < count[:, None]] = known[place]
        symbols, rows = out.copy(), np.arange(len(words))
        whole, rank = self.pair(symbols[:, :-1], symbols[:, 1:])
        columns = np.arange(width)
        while len(rows):
            best = rank.argmin(axis=1)
            going = rank[np.arange(len(rows)), best] < NEVER
            if not going.all():
                out[rows[~going], :symbols.shape[1]] = symbols[~going]
                out[rows[~going], symbols.shape[1]:] = gap
                rows, symbols, whole, rank, best = (x[going] for x in (
                    rows, symbols, whole, rank, best))
            if not len(rows):
                break
            at = np.arange(len(rows))
            symbols[at, best] = whole[at, best]
            size = symbols.shape[1] - 1
            keep = columns[:size] + (columns[:size] > best[:, None])
            symbols = np.take_along_axis(symbols, keep, 1)
            if size == 1:
                out[rows, 0], out[rows, 1:] = symbols[:, 0], gap
                break
            # Pair j goes; pairs j - 1 and j (formerly j + 1) are offered anew.
            keep = columns[:size - 1] + (columns[:size - 1] >= best[:, None])
            whole, rank = np.take_along_axis(whole, keep, 1), np.take_along_axis(rank, keep, 1)
            for j in (best - 1, best):
                ok = np.flatnonzero((j >= 0) & (j < size - 1))
                whole[ok, j[ok]], rank[ok, j[ok]] = self.pair(
                    symbols[ok, j[ok]], symbols[ok, j[ok] + 1])
        return out

    def _ids(self, symbols: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace what is outside the vocabulary by byte pieces; `count` symbols per word."""
        odd = np.flatnonzero(symbols < 0)
        if not len(odd):
            return symbols.astype(np.int32), count
        spelled = [chr(-1 - s).encode() for s in symbols[odd].tolist()]
        size = np.ones(len(symbols), np.int64)
        size[odd] = [len(s) for s in spelled]
        out = np.repeat(symbols, size)
        starts = np.cumsum(size) - size
        out[ragged(starts[odd], size[odd])] = self.byte_ids[
            np.frombuffer(b"".join(spelled), np.uint8)]
        word = np.repeat(np.arange(len(count)), count)
        return out.astype(np.int32), np.bincount(word, size, len(count)).astype(np.int64)

    def learn(self, words: list[bytes], verify: bool) -> None:
        """Encode new words (each starts with a space) and keep their ids."""
        marked = [w.decode().replace(" ", MARK) for w in words]
        order = sorted(range(len(marked)), key=lambda i: len(marked[i]))
        gap = -(1 << 31)
        for a in range(0, len(order), 8192):
            part = [marked[i] for i in order[a:a + 8192]]
            short = [w for w in part if len(w) <= BLOCK_WORD]
            flat, count = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            if short:
                block = self.agendas(short, max(2, len(short[-1])))
                flat.append(block[block > gap])
                count.append((block > gap).sum(axis=1))
            for w in part[len(short):]:
                flat.append(np.array(self.agenda(w)))
                count.append(np.array([len(flat[-1])]))
            ids, size = self._ids(np.concatenate(flat), np.concatenate(count))
            if verify:
                self.compare(part, ids, size)
            self.memo.update(zip([words[i] for i in order[a:a + 8192]],
                                 range(len(self.memo), len(self.memo) + len(part)), strict=True))
            self.flat.append(ids)
            self.lengths.append(size)

    def compare(self, words: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        """Hold encoded words, shortest first, against the library."""
        alone = sum(len(w) == 1 for w in words)  # the library has no text of a mark alone
        theirs = self.library.encode([w[1:].replace(MARK, " ") for w in words[alone:]],
                                     num_threads=1)
        count = np.fromiter(map(len, theirs), np.int64, len(theirs))
        flat = np.fromiter(chain.from_iterable(theirs), np.int32, int(count.sum()))
        if not (np.array_equal(count, size[alone:])
                and np.array_equal(flat, ids[int(size[:alone].sum()):])):
            odd = [w for w, own, n in zip(words[alone:], theirs, size[alone:], strict=True)
                   if len(own) != n] or words[alone:]
            raise AssertionError(f"the library encodes {odd[0][:80]!r} or a word near it otherwise")

    def encode(self, column: pa.Array, verify: bool = True) -> pa.ListArray:
        """Ids of every text of a string column, null as empty."""
        column = pc.fill_null(column.cast(pa.string()), "")
        spaced = pc.if_else(pc.equal(pc.binary_length(column), 0), "",
                            pc.binary_join_element_wise(
                                "", pc.replace_substring(column, MARK, " "), " "))
        data, offsets = texts_of(spaced)
        space = data == 32
        start = space.copy()
        start[1:] &= ~space[:-1]
        start[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        cuts = np.append(np.flatnonzero(start), len(data))
        words = runs(data, cuts)
        distinct = words.dictionary.to_pylist()
        if len(self.memo) > MEMO_WORDS:
            self.forget()
        new = [w for w in distinct if w not in self.memo]
        if new:
            self.learn(new, verify)
            self.flat, self.lengths = [np.concatenate(self.flat)], [np.concatenate(self.lengths)]
        place = np.fromiter(map(self.memo.__getitem__, distinct), np.int64, len(distinct))
        flat = self.flat[0] if self.flat else np.zeros(0, np.int32)
        length = self.lengths[0] if self.lengths else np.zeros(0, np.int64)
        start_of = np.cumsum(length) - length
        at = place[words.indices.to_numpy()] if len(distinct) else np.zeros(0, np.int64)
        ids = flat[ragged(start_of[at], length[at])]
        ends = np.concatenate([[0], np.cumsum(length[at])])
        return pa.ListArray.from_arrays(
            pa.array(ends[np.searchsorted(cuts, offsets)].astype(np.int32)), pa.array(ids))

    # -- decoding ----------------------------------------------------------------------------

    def decode(self, column: pa.ListArray) -> pa.Array:
        """Texts of a column of ids, null as none."""
        if column.null_count or column.offset:
            column = pa.array([x or [] for x in column.to_pylist()], pa.list_(pa.int32()))
        offsets = column.offsets.to_numpy().astype(np.int64)
        ids = column.values.to_numpy()[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        size = self.shown_length[ids]
        data = self.shown[ragged(self.shown_start[ids], size)]
        ends = np.concatenate([[0], np.cumsum(size)])[offsets]
        # The mark that encoding puts before a text goes.
        first = ends[:-1][(ends[:-1] < ends[1:])]
        whole = np.searchsorted(np.cumsum(size), first, "right")
        drop = first[(data[first] == 32) & self.is_text[ids[whole]]]
        gone = np.zeros(len(data) + 1, np.int64)
        gone[drop + 1] = 1
        ends = ends - np.cumsum(gone)[ends]
        data = np.delete(data, drop)
        raw = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
            None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])
        try:
            if not size.all():
                raise pa.ArrowInvalid("control pieces break runs of bytes")
            return raw.cast(pa.string())
        except pa.ArrowInvalid:  # only for ids that no text encodes to
            return pa.array([self.plain(ids[a:b]) for a, b in zip(
                offsets[:-1], offsets[1:], strict=True)], pa.string())

    def plain(self, ids: np.ndarray) -> str:
        """One text, each byte that is no part of a character as U+FFFD."""
        out, run, begun = [], b"", False

        def spell() -> str:
            said, rest = [], run
            while rest:
                for n in range(1, min(4, len(rest)) + 1):
                    try:
                        said.append(rest[:n].decode())
                        rest = rest[n:]
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    said.append("�")
                    rest = rest[1:]
            return "".join(said)

        for i in ids.tolist():
            a = self.shown_start[i]
            own = self.shown[a:a + self.shown_length[i]].tobytes()
            if self.is_byte[i]:
                run, begun = run + own, True
                continue
            out.append(spell())
            run = b""
            marked = not begun and own[:1] == b" " and bool(self.is_text[i])
            out.append(own.decode()[int(marked):])
            begun = begun or bool(own)
        return "".join([*out, spell()])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
           verify: bool = True) -> DataFrame:
    """(key, ids): the ids of every whole text. A map over the rows: nothing is shuffled."""
    rows = pick(docs, key, text)
    kind = rows.schema[0].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for part in steps(batch, text):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), words.encode(part.column(1), verify)], [key, "ids"])

    return map_batches(rows, work, f"`{key}` {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add the column `decoded` to the result of `encode`."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                ids = part.column(part.schema.get_field_index("ids"))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, words.decode(ids)], [*part.schema.names, "decoded"])

    return map_batches(encoded, work, f"{kinds}, decoded string")


def coded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
          verify: bool = True) -> DataFrame:
    """(key, ids, decoded): `encode` and `decode` in one pass, with one process per task."""
    rows = pick(docs, key, text)
    kind = rows.schema[0].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for part in steps(batch, text):
                ids = words.encode(part.column(1), verify)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), ids, words.decode(ids)], [key, "ids", "decoded"])

    return map_batches(rows, work, f"`{key}` {kind}, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return coded(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))

"""Ids of words by tokenizers of merges, each distinct word of a batch encoded once.

For tokenizers that never join what lies before and behind certain places, texts are cut there. Words of
plain symbols are merged here, all words of a batch together: in every round each word joins its
adjacent pair of the best rank, the first of equal ones. All other words go to the tokenizer's library,
once per process as long as they are remembered.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from remitwise.llm.common import PairTable, ragged, runs

# Words of the library that a process remembers, and the longest; memory starts anew when full.
MEMO_WORDS, MEMO_BYTES = 1 << 17, 64
# The longest words that are merged here, and how many are merged together.
MERGE_BYTES, MERGE_WORDS = 32, 8192

LETTERS = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def file_tokenizer(path: str, plain: bool):
    """A tokenizer of the `tokenizers` library; with `plain`, special strings are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    if plain:
        out.encode_special_tokens = True
    return out


class Merges:
    """Pairs of symbols with their ranks, and the symbols of bytes; -1 for other bytes.

    `last` holds the symbols of bytes at the end of a word, `blank` that of a blank before a word.
    """

    def __init__(self, left: list[int], right: list[int], rank: list[int], joined: list[int],
                 symbol: dict[int, int], last: dict[int, int], blank: int):
        key = (np.array(left, np.int64) << 32 | np.array(right, np.int64)).astype(np.uint64)
        first = np.unique(key, return_index=True)[1]
        self.table = PairTable(key[first], np.array(rank, np.int32)[first])
        self.joined = np.array(joined, np.int32)
        self.symbol, self.last = np.full(256, -1, np.int32), np.full(256, -1, np.int32)
        self.symbol[list(symbol)], self.last[list(last)] = list(symbol.values()), list(last.values())
        self.blank = blank

    @classmethod
    def of_file(cls, path: str) -> Merges:
        """Of a vocabulary file, for words of ASCII letters and perhaps a blank before them."""
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        return cls([vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs], [*range(len(pairs))],
                   [vocab[a + b] for a, b in pairs], {c: vocab[chr(c)] for c in LETTERS},
                   {c: vocab[chr(c) + suffix] for c in LETTERS},
                   -1 if suffix else vocab["Ġ"])  # byte-level sign of a blank

    @classmethod
    def of_pieces(cls, pieces: list[str], scores: list[float]) -> Merges:
        """Of scored pieces: the best is the highest score, however a piece is parted; for words
        of printing ASCII characters and a blank before them."""
        place = {p: i for i, p in enumerate(pieces)}
        order = sorted(range(len(pieces)), key=lambda i: -scores[i])
        parts = [(place[pieces[i][:k]], place[pieces[i][k:]], rank)
                 for rank, i in enumerate(order) for k in range(1, len(pieces[i]))
                 if pieces[i][:k] in place and pieces[i][k:] in place]
        plain = {c: place[chr(c)] for c in range(33, 127) if chr(c) in place}
        left, right, rank = zip(*parts, strict=True)
        return cls(left, right, rank, order, plain, plain, place["▁"])

    def own(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The words that can be merged here."""
        plain = np.concatenate([[0], np.cumsum(self.last[data] >= 0)])
        count = plain[start + length] - plain[start]
        blank = np.zeros(len(start), np.int64)
        if self.blank >= 0:
            blank[length > 0] = data[start[length > 0]] == 32
        return (count + blank == length) & (count > 0) & (length <= MERGE_BYTES)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        found = self.table.find((left.astype(np.int64) << 32 | right).astype(np.uint64))
        return np.where((found < 0) | (right < 0) | (left < 0), np.iinfo(np.int32).max, found)

    def merged(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words given as rows of symbols, -1 behind their end, and their numbers."""
        none = np.iinfo(np.int32).max
        out, live = symbols.copy(), np.arange(len(symbols))
        rank = self._rank(symbols[:, :-1], symbols[:, 1:])
        columns = np.arange(symbols.shape[1])
        while len(live):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(live)), at]
            go = best < none
            if not go.all():
                out[live[~go]] = symbols[~go]
                live, symbols, rank, at, best = live[go], symbols[go], rank[go], at[go], best[go]
                if not len(live):
                    break
            row = np.arange(len(live))
            move = np.minimum(columns + (columns > at[:, None]), len(columns) - 1)
            symbols = np.take_along_axis(symbols, move, 1)
            symbols[:, -1] = -1
            symbols[row, at] = self.joined[best]
            rank = np.take_along_axis(rank, np.minimum(move[:, :-1], len(columns) - 2), 1)
            rank[:, -1] = none
            inside = at < len(columns) - 1
            rank[row[inside], at[inside]] = self._rank(
                symbols[row[inside], at[inside]], symbols[row[inside], at[inside] + 1])
            back = at > 0
            rank[row[back], at[back] - 1] = self._rank(
                symbols[row[back], at[back] - 1], symbols[row[back], at[back]])
        return out[out >= 0], (out >= 0).sum(axis=1)

    def ids(self, data: np.ndarray, start: np.ndarray, length: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
        """All ids of words one after the other, and their numbers; shortest words first is best."""
        flats, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for a in range(0, len(start), MERGE_WORDS):
            begin, size = start[a:a + MERGE_WORDS], length[a:a + MERGE_WORDS]
            columns = np.arange(max(2, int(size.max())))
            inside = columns < size[:, None]
            byte = data[np.where(inside, begin[:, None] + columns, 0)]
            symbols = np.where(inside, self.symbol[byte], -1)
            if self.blank >= 0:
                symbols[:, 0] = np.where(byte[:, 0] == 32, self.blank, symbols[:, 0])
            row = np.arange(len(begin))
            symbols[row, size - 1] = self.last[byte[row, size - 1]]
            flat, count = self.merged(symbols.astype(np.int32))
            flats.append(flat)
            sizes.append(count)
        return np.concatenate(flats), np.concatenate(sizes)


class Coder:
    """Ids of words: merged here where `merges` can, else by the library."""

    def __init__(self, merges: Merges, library: Callable[[list[str]], list[list[int]]]):
        self.merges, self.library = merges, library
        self.known: dict[bytes, list[int]] = {}

    def _by_library(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > MEMO_WORDS:
            self.known = {}
        new = [w for w in words if w not in self.known]
        now = dict(zip(new, self.library([w.decode() for w in new]), strict=True)) if new else {}
        lists = [now[w] if w in now else self.known[w] for w in words]
        self.known.update((w, ids) for w, ids in now.items() if len(w) <= MEMO_BYTES)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((x for ids in lists for x in ids), np.int32, int(sizes.sum())), sizes

    def codes(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, ids per word).

        `cuts` are the ends of the words in `data`, after a first 0.
        """
        if len(cuts) < 2:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        words = runs(data, cuts)
        distinct = words.dictionary
        ends = np.frombuffer(distinct.buffers()[1], np.int32)[:len(distinct) + 1].astype(np.int64)
        byte = np.frombuffer(distinct.buffers()[2], np.uint8)
        start, length = ends[:-1], np.diff(ends)
        own = self.merges.own(byte, start, length)
        mine = np.flatnonzero(own)
        mine = mine[np.argsort(length[mine], kind="stable")]
        rest = np.flatnonzero(~own)
        flat, size = self.merges.ids(byte, start[mine], length[mine])
        others, other_size = self._by_library(distinct.take(pa.array(rest)).to_pylist())
        # The words' ids lie in the order of `mine`, then `rest`.
        place = np.empty(len(distinct), np.int64)
        place[np.concatenate([mine, rest])] = np.arange(len(distinct))
        sizes = np.concatenate([size, other_size])
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
            pa.array(np.concatenate([flat, others]), pa.int32()))
        at = place[words.indices.to_numpy()]
        return lists.take(pa.array(at)).values.to_numpy(), sizes[at]


def file_coder(path: str, plain: bool) -> Coder:
    library = file_tokenizer(path, plain)
    return Coder(Merges.of_file(path), lambda words: [
        e.ids for e in library.encode_batch_fast(words, add_special_tokens=False)])


def cut_at(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Cuts before the marked bytes and at both ends of every text that is not empty."""
    marked = np.append(starts, False)
    marked[offsets] = True
    marked[0] = False
    cuts = np.flatnonzero(marked)
    return np.concatenate([[0], cuts]) if len(starts) else np.zeros(1, np.int64)


def per_text(sizes: np.ndarray, cuts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The offsets of the texts among the ids of their words."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return ends[np.searchsorted(cuts, offsets)]


def spelled(strings: pa.Array, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends): the strings with these places, one after the other."""
    out = strings.take(pa.array(ids))
    ends = np.frombuffer(out.buffers()[1], np.int32 if out.type == pa.binary() else np.int64)
    data = out.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8))[:ends[len(ids)]], \
        ends[:len(ids) + 1].astype(np.int64)

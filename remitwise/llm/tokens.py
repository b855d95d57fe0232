"""Operator 5: token counts by a compiled finite-state tokenizer (byte-level BPE).

Two deterministic transducers run one after the other; no token id is ever built.

1. The splitter reads characters and marks where pre-tokens begin. It has 12 states and its
   transitions are annotated with the boundaries that they settle (at this character, at the one
   before). A text is cut into chunks; each chunk becomes a map from entry state to exit state, the
   maps compose through a parallel prefix scan, and then all chunks run at once from their true
   entry states. A text longer than a step is a step of its own.
2. The counter reads the bytes of a pre-token and annotates each transition with the token count so
   far. It rests on a property of BPE: the encoding of a prefix that ends in token t is the encoding
   of what precedes t, then t, and a sequence of tokens is an encoding if and only if each adjacent
   pair is. So its state is the set of places at which a token may still begin, each with its node
   in the automaton of token prefixes, its last token and its count, and a transition is made of two
   compiled tables: the automaton's hops, and which token may follow which (compiled from the merge
   ranks when a pair is first met, up to `MEMO_PAIRS`). All new pre-tokens of a step advance
   together, one byte each per round.

Counts of distinct pre-tokens are kept up to `MEMO_WORDS`. The string of an added special token
inside a text is one token, as is the library's default. Nulls and empty texts have no bytes and no
tokens. Repeated rows and extra columns do not matter. The vocabulary path is a parameter.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from remitwise.llm.common import PairTable, map_batches, pick, runs, steps

MEMO_PAIRS = 4_000_000
MEMO_WORDS = 300_000
CHUNK = 256
# Longer pre-tokens are read one at a time.
BLOCK_WORD = 64
# No text holds lone surrogates, so they can stand for what is no character.
END, SPECIAL = "\ud800", "\ud801"

# Character classes of the splitter.
SPACE, WHITE, LETTER, DIGIT, OTHER, QUOTE, SHORT, R, V, L, E, STOP = range(12)
# States. START: a token has ended. ONE, WIDE: one white character, a space or another one. SPACES,
# WIDES: several, the last a space or another one. QUOTED: a quote that may begin a contraction,
# then with its first letter.
START, ONE, WIDE, SPACES, WIDES, WORD, NUMBER, MARKS, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L = range(12)
HERE, BEFORE = 1, 2


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    letters = (LETTER, SHORT, R, V, L, E)
    fresh = {SPACE: ONE, WHITE: WIDE, DIGIT: NUMBER, OTHER: MARKS, QUOTE: QUOTED, STOP: START}
    fresh |= dict.fromkeys(letters, WORD)
    to, said = np.zeros((12, 12), np.uint8), np.zeros((12, 12), np.uint8)
    for state in range(12):
        for c in range(12):
            to[state, c], said[state, c] = fresh[c], HERE

    def go(state: int, classes: tuple[int, ...], target: int, marks: int = 0) -> None:
        for c in classes:
            to[state, c], said[state, c] = target, marks

    go(WORD, letters, WORD)
    go(NUMBER, (DIGIT,), NUMBER)
    go(MARKS, (OTHER, QUOTE), MARKS)
    # A single space joins what follows; of several white characters the last one does.
    for state, marks in ((ONE, 0), (SPACES, BEFORE)):
        go(state, letters, WORD, marks)
        go(state, (DIGIT,), NUMBER, marks)
        go(state, (OTHER, QUOTE), MARKS, marks)
    for c in (DIGIT, OTHER, QUOTE, *letters):
        said[WIDES, c] = HERE | BEFORE
    for state in (ONE, WIDE, SPACES, WIDES):
        go(state, (SPACE,), SPACES)
        go(state, (WHITE,), WIDES)
    go(QUOTED, (OTHER, QUOTE), MARKS)
    go(QUOTED, (SHORT,), START)
    go(QUOTED, (R,), QUOTED_R)
    go(QUOTED, (V,), QUOTED_V)
    go(QUOTED, (L,), QUOTED_L)
    for state, last in ((QUOTED_R, E), (QUOTED_V, E), (QUOTED_L, L)):
        for c in range(12):
            said[state, c] = BEFORE | HERE
        go(state, letters, WORD, BEFORE)
        go(state, (last,), START)
    return to, said


TO, SAID = _transitions()


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point."""
    import regex

    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for pattern, c in ((r"\p{White_Space}", WHITE), (r"\p{L}", LETTER), (r"\p{N}", DIGIT)):
        found = "".join(regex.findall(pattern + "+", every))
        out[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = c
    for chars, c in ((" ", SPACE), ("'", QUOTE), ("stmd", SHORT), ("r", R), ("v", V), ("l", L),
                     ("e", E), (END + SPECIAL, STOP)):
        out[[ord(x) for x in chars]] = c
    return out


def boundaries(kinds: np.ndarray) -> np.ndarray:
    """True where a pre-token begins, for the classes of a stream of characters."""
    n = len(kinds)
    rows = -(-n // CHUNK)
    grid = np.full(rows * CHUNK, STOP, np.uint8)
    grid[:n] = kinds
    # Character j of all chunks lies together.
    grid = np.ascontiguousarray(grid.reshape(rows, CHUNK).T).astype(np.intp)
    flat = TO.ravel()
    # The map of each chunk: exit state for each of the 12 entry states.
    maps = np.repeat(np.arange(12, dtype=np.intp)[:, None], rows, axis=1)
    for j in range(CHUNK):
        maps = flat[maps * 12 + grid[j]].astype(np.intp)
        if j % 16 == 15 and (maps == maps[0]).all():
            # Every chunk's map is constant by now, so the rest is the same from any entry.
            state = maps[0]
            for k in range(j + 1, CHUNK):
                state = flat[state * 12 + grid[k]].astype(np.intp)
            maps = np.broadcast_to(state, (12, rows))
            break
    # Inclusive prefix scan of map composition.
    maps, step = np.array(maps), 1
    while step < rows:
        later = np.take_along_axis(maps[:, step:], maps[:, :-step], axis=0)
        maps = np.concatenate([maps[:, :step], later], axis=1)
        step *= 2
    state = np.concatenate([[START], maps[START, :-1]]).astype(np.intp)
    said, marks = SAID.ravel(), np.zeros((CHUNK, rows), np.uint8)
    for j in range(CHUNK):
        at = state * 12 + grid[j]
        marks[j] = said[at]
        state = flat[at].astype(np.intp)
    marks = marks.T.ravel()[:n]
    out = (marks & HERE).astype(bool)
    out[:-1] |= (marks[1:] & BEFORE).astype(bool)
    return out


def _byte_letters() -> dict[str, int]:
    """The printable character that a byte-level vocabulary file writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Counter:
    """The counting transducer of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"]
        if (model["type"] != "BPE" or spec["normalizer"] or spec["post_processor"]
                or split["type"] != "ByteLevel" or split["add_prefix_space"]
                or not split["use_regex"] or model["ignore_merges"] or model["dropout"]
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
                       for t in spec["added_tokens"])):
            raise ValueError("not a byte-level BPE vocabulary with the plain rules")
        byte = _byte_letters()
        added = {t["content"] for t in spec["added_tokens"]}
        self.special = sorted(added, key=len, reverse=True)
        self.ids = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items()
                    if t not in added}
        size = max(self.ids.values()) + 1
        # Birth of a token: the rank of the merge that makes it; bytes are there from the start.
        self.birth = np.full(size, -1, np.int64)
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        made = set()
        for r, merge in enumerate(model["merges"]):
            a, b = (bytes(byte[c] for c in m)
                    for m in (merge if isinstance(merge, list) else merge.split(" ")))
            whole = self.ids[a + b]
            made.add(whole)
            self.birth[whole] = r
            self.left[whole], self.right[whole] = self.ids[a], self.ids[b]
        if len(made) != len(model["merges"]):
            raise ValueError("two merges make one token")
        whole = np.flatnonzero(self.birth >= 0)
        self.merges = PairTable(self.key(self.left[whole], self.right[whole]), self.birth[whole])
        self._compile()
        self.pairs = PairTable(np.zeros(0), np.zeros(0))
        self.memo: dict[bytes, int] = {}

    def _compile(self) -> None:
        """The automaton of the strings that begin a token."""
        nodes = {b"": 0}
        for token in self.ids:
            for k in range(1, len(token) + 1):
                nodes.setdefault(token[:k], len(nodes))
        self.node_token = np.full(len(nodes), -1, np.int64)
        for token, i in self.ids.items():
            self.node_token[nodes[token]] = i
        inner = [(nodes[s[:-1]] * 256 + s[-1], n) for s, n in nodes.items() if s]
        keys, values = (np.array(x) for x in zip(*inner, strict=True))
        self.hops = PairTable(keys, values)

    @staticmethod
    def key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((a.astype(np.uint64) + np.uint64(1)) << np.uint64(32)) | b.astype(np.uint64)

    def stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether tokens a, b are the encoding of their joint string.

        Goes back in time along the seam: of its two sides the younger one is taken apart, until
        both are bytes. The tokens are stable if no pair at the seam merges before one of its
        sides is used up; a side on the right is used up after an equal merge at the seam.
        """
        out = np.ones(len(a), bool)
        rows, end = np.arange(len(a)), np.full(len(a), np.int64(1) << 40)
        while len(rows):
            rank = self.merges.find(self.key(a, b))
            broken = (rank >= 0) & (rank < end)
            out[rows[broken]] = False
            first = self.birth[a] > self.birth[b]
            going = ~broken & ((self.birth[a] >= 0) | (self.birth[b] >= 0))
            rows, a, b, first = rows[going], a[going], b[going], first[going]
            end = np.where(first, self.birth[a], self.birth[b] + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return out

    def adjacent(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """`stable`, compiled pair by pair when first met; a = -1 (no token) fits any b."""
        keys = self.key(a, b)
        known = self.pairs.find(keys)
        new, first = np.unique(keys[(known < 0) & (a >= 0)], return_index=True)
        if len(new):
            place = np.flatnonzero((known < 0) & (a >= 0))[first]
            if self.pairs.count > MEMO_PAIRS:
                self.pairs = PairTable(np.zeros(0), np.zeros(0))
            self.pairs.add(new, self.stable(a[place], b[place]).astype(np.int32))
            known = self.pairs.find(keys)
        return (known == 1) | (a < 0)

    def lockstep(self, words: list[bytes]) -> np.ndarray:
        """Token counts of words in order of length: the transducer reads byte i of all of them."""
        m, width = len(words), len(words[-1])
        length = np.fromiter(map(len, words), np.int64, m)
        grid = np.zeros((m, width), np.int64)
        grid[np.arange(width) < length[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        last, count = np.full((m, width + 1), -1), np.zeros((m, width + 1), np.int64)
        row, begin, node = (np.zeros(0, np.int64) for _ in range(3))
        for i in range(width):
            reading = np.arange(np.searchsorted(length, i, "right"), m)
            alive = length[row] > i
            # A token may begin here, and those begun before may go on.
            row = np.concatenate([row[alive], reading])
            begin = np.concatenate([begin[alive], np.full(len(reading), i)])
            node = np.concatenate([node[alive], np.zeros(len(reading), np.int64)])
            node = self.hops.find((node * 256 + grid[row, i]).astype(np.uint64)).astype(np.int64)
            alive = node >= 0
            row, begin, node = row[alive], begin[alive], node[alive]
            token = self.node_token[node]
            ends = np.flatnonzero(token >= 0)
            r, p, t = row[ends], begin[ends], token[ends]
            fits = self.adjacent(last[r, p], t)
            r, p, t = r[fits], p[fits], t[fits]
            last[r, i + 1], count[r, i + 1] = t, count[r, p] + 1
        return count[np.arange(m), length]

    def alone(self, word: bytes) -> int:
        """Token count of one long word, with a window as wide as the longest token."""
        window: list[tuple[int, int]] = [(-1, 0)]
        live: list[tuple[int, int]] = []
        for i, byte in enumerate(word):
            nodes = np.array([n for _, n in live] + [0])
            begins = [p for p, _ in live] + [i]
            hops = self.hops.find((nodes * 256 + byte).astype(np.uint64)).tolist()
            live = [(p, n) for p, n in zip(begins, hops, strict=True) if n >= 0]
            base = i + 1 - len(window)
            ends = [(p, int(self.node_token[n])) for p, n in live if self.node_token[n] >= 0]
            fits = self.adjacent(np.array([window[p - base][0] for p, _ in ends]),
                                 np.array([t for _, t in ends]))
            p, t = ends[int(np.argmax(fits))]
            window.append((t, window[p - base][1] + 1))
            oldest = min((p for p, _ in live), default=i + 1)
            window = window[oldest - base:]
        return window[-1][1]

    def learn(self, words: list[bytes]) -> None:
        order = sorted(words, key=len)
        short = [w for w in order if len(w) <= BLOCK_WORD]
        for a in range(0, len(short), 16384):
            part = short[a:a + 16384]
            self.memo.update(zip(part, self.lockstep(part).tolist(), strict=True))
        for word in order[len(short):]:
            self.memo[word] = self.alone(word)

    def counts(self, column: pa.Array) -> np.ndarray:
        """Tokens of every text of a string column, null as empty."""
        texts = pc.fill_null(column.cast(pa.string()), "").to_pylist()
        if not texts:
            return np.zeros(0, np.int64)
        stream = END.join(texts) + END
        for token in self.special:
            stream = stream.replace(token, SPECIAL)
        points = np.frombuffer(stream.encode("utf-32-le", "surrogatepass"), np.uint32)
        data = np.frombuffer(stream.encode("utf-8", "surrogatepass"), np.uint8)
        begins = np.flatnonzero(boundaries(classes()[points]))
        first_bytes = np.flatnonzero((data & 0xC0) != 0x80)
        words = runs(data, np.append(first_bytes[begins], len(data)))
        distinct = words.dictionary.to_pylist()
        if len(self.memo) + len(distinct) > MEMO_WORDS:
            self.memo = {}
        if not self.memo:
            self.memo = {END.encode("utf-8", "surrogatepass"): 0,
                         SPECIAL.encode("utf-8", "surrogatepass"): 1}
        self.learn([w for w in distinct if w not in self.memo])
        sizes = np.fromiter(map(self.memo.__getitem__, distinct), np.int64, len(distinct))
        ends = np.cumsum(sizes[words.indices.to_numpy()])
        # Each text ends with its own mark, a pre-token of no tokens.
        last = ends[np.flatnonzero(points[begins] == ord(END))]
        return np.diff(last, prepend=0)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every whole text; a map over the rows."""
    rows = pick(docs, key, text)
    kind = rows.schema[0].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            for part in steps(batch, text):
                count = own.counts(part.column(1))
                size = pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), size, pa.array(count), pa.array(count > limit)],
                    [key, "n_bytes", "n_tokens", "over_limit"])

    return map_batches(
        rows, work, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")

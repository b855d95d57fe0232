"""Operator 10: language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from a seed and its code point. A trigram is
bound from the vectors of its letters, the first rotated twice, the second once; a text is the bundle
(sum) of its trigrams, a language the bundle of its learning texts. A text has the language whose
prototype has the greatest cosine with it (of equals, the lower name). Bundling is linear, so a text
is counted by trigram first and each distinct trigram enters once, with its count.

Case does not count; whatever is no letter separates words. Learning sums one vector per language
and task before the exchange, so what is shuffled and what the driver holds, one vector of `DIMENSIONS`
whole numbers per language, does not grow with the documents.

Null texts and texts without a letter: `und`, score 0, and they are not learned from. Documents
without a language are not learned from. Without any learned language everything is `und`. Null
doc_id: predicted and learned from as any other, not held out. Repeated rows count as often as they
appear. Extra columns are ignored. A prediction sees the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from remitwise.llm.common import STEP_BYTES, PairTable, map_batches, pick, steps

DIMENSIONS = 1024
UNKNOWN = "und"
# Trigrams whose vectors a process keeps; beyond that it starts anew.
MEMO_TRIGRAMS = 25_000
# No text holds lone surrogates: one can stand between texts.
END = "\ud800"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """True for the code points that are letters."""
    import regex

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = np.zeros(0x110000, bool)
    found = "".join(regex.findall(r"\p{L}+", every))
    out[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = True
    return out


class Encoder:
    """Trigram counts and bundled vectors of texts."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self.symbols: dict[int, np.ndarray] = {}
        self.forget()

    def forget(self) -> None:
        self.places = PairTable(np.zeros(0), np.zeros(0))
        self.vectors = np.zeros((0, self.dimensions), np.int8)

    def symbol(self, point: int) -> np.ndarray:
        if point not in self.symbols:
            if len(self.symbols) > MEMO_TRIGRAMS:
                self.symbols.clear()
            draw = np.random.Generator(np.random.Philox(key=[self.seed, point]))
            self.symbols[point] = draw.integers(0, 2, self.dimensions, np.int8) * 2 - 1
        return self.symbols[point]

    def bind(self, key: int) -> np.ndarray:
        a, b, c = key >> 42, (key >> 21) & 0x1FFFFF, key & 0x1FFFFF
        return np.roll(self.symbol(a), 2) * np.roll(self.symbol(b), 1) * self.symbol(c)

    def counted(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(row, trigrams, counts) of each text that has a letter; trigrams are places of vectors."""
        texts = pc.fill_null(column.cast(pa.string()), "").to_pylist()
        stream = (END + END.join(texts) + END).lower()
        points = np.frombuffer(stream.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = points == ord(END)
        # One blank for each run of what is no letter, before each text's first word, after its last.
        points = np.where(letters()[points], points, 32)
        blank = points == 32
        keep = ~blank
        keep[1:] |= blank[1:] & (~blank[:-1] | ends[1:])
        keep[0] = True
        row = (np.cumsum(ends) - 1)[keep]
        points = points[keep].astype(np.uint64)
        if len(points) < 3:
            return
        keys = points[:-2] << np.uint64(42) | points[1:-1] << np.uint64(21) | points[2:]
        # The blank that begins a text belongs to it, and no trigram spans two texts.
        inside = (row[:-2] == row[1:-1]) & (points[1:-1] != 32)
        keys, row = keys[inside], row[1:-1][inside]
        if self.places.count > MEMO_TRIGRAMS:
            self.forget()
        place = self.places.find(keys)
        new = np.unique(keys[place < 0])
        if len(new):
            self.places.add(new, np.arange(len(self.vectors), len(self.vectors) + len(new)))
            self.vectors = np.concatenate(
                [self.vectors, np.stack([self.bind(k) for k in new.tolist()])])
            place = self.places.find(keys)
        cuts = np.append(np.flatnonzero(np.diff(row, prepend=-1)), len(row))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            count = np.bincount(place[a:b])
            found = np.flatnonzero(count)
            yield int(row[a]), found, count[found]


@lru_cache(maxsize=2)
def encoder(dimensions: int, seed: int) -> Encoder:
    return Encoder(dimensions, seed)


def learn(docs: DataFrame, dimensions: int = DIMENSIONS, seed: int = 0) -> dict[str, np.ndarray]:
    """The prototype of each language of (text, lang): one unit vector per language."""
    rows = pick(docs, "lang", "text").filter("lang is not null and text is not null")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(dimensions, seed)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for step in steps(batch, "text", STEP_BYTES // 2):
                langs = step.column(0).to_pylist()
                counts: dict[str, np.ndarray] = {}
                for row, found, count in own.counted(step.column(1)):
                    total = counts.get(langs[row])
                    if total is None:
                        total = counts[langs[row]] = np.zeros(len(own.vectors), np.int64)
                    total[found] += count
                for lang, total in counts.items():
                    found = np.flatnonzero(total)
                    bundle = np.zeros(dimensions, np.int64)
                    for a in range(0, len(found), 1024):
                        part = found[a:a + 1024]
                        bundle += total[part] @ own.vectors[part].astype(np.int64)
                    sums[lang] = sums.get(lang, 0) + bundle
        for lang, bundle in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)),
                 pa.array(bundle)], ["lang", "place", "value"])

    summed = (map_batches(rows, work, "lang string, place int, value bigint")
              .groupBy("lang", "place").sum("value"))
    model: dict[str, np.ndarray] = {}
    for lang, place, value in summed.collect():  # languages x dimensions
        model.setdefault(lang, np.zeros(dimensions))[place] = value
    return {lang: v / np.linalg.norm(v) for lang, v in sorted(model.items()) if v.any()}


def predict(docs: DataFrame, model: dict[str, np.ndarray], dimensions: int = DIMENSIONS,
            seed: int = 0, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(columns to carry, lang_pred, score) of every whole text; a map over the rows."""
    rows = pick(docs, *carry, *({"text"} - set(carry)))
    kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in carry)
    names = np.array([*model, UNKNOWN])
    prototypes = np.array([*model.values()]).reshape(len(model), dimensions).astype(np.float32)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(dimensions, seed)
        for batch in batches:
            for step in steps(batch, "text", STEP_BYTES // 2):
                best = np.full(step.num_rows, len(names) - 1)
                score = np.zeros(step.num_rows)
                for row, found, count in own.counted(step.column("text")):
                    bundle = count.astype(np.float32) @ own.vectors[found].astype(np.float32)
                    size = np.linalg.norm(bundle)
                    if len(prototypes) and size:
                        cosine = prototypes @ bundle / size
                        best[row] = int(cosine.argmax())
                        score[row] = min(1.0, max(0.0, float(cosine[best[row]])))
                yield pa.RecordBatch.from_arrays(
                    [*(step.column(c) for c in carry),
                     pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                    [*carry, "lang_pred", "score"])

    return map_batches(rows, work, f"{kinds}lang_pred string, score double")


HELD_OUT = "coalesce(crc32(cast(doc_id as string)) % 3 = 1, false)"


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the documents that are not held out."""
    learned = pick(docs, "doc_id", "text", "lang").filter(f"not {HELD_OUT}")
    return predict(docs, learn(learned)).selectExpr(
        "doc_id", f"{HELD_OUT} as held_out", "lang_pred", "score")

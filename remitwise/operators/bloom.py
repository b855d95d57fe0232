"""A mergeable filter of join keys, so that only rows that may have a partner are shuffled.

The filter is a Bloom filter in words of 64 bits: a key sets four bits of one word. Words are merged by
`bit_or`, map side first, so no task holds more than the words it has seen, and the merged words are a
table of bounded size that is broadcast. A key that was put in always passes; others pass seldom, and
more often when the filter is fuller than it was sized for, so the exact join has to follow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 12
# The largest filter: 8 MB of bits, 16 MB as a table.
MOST_WORDS = 1 << 20


def words_for(keys: int) -> int:
    """Words of a filter for so many keys: a power of two, bounded."""
    needed = max(1, keys * BITS_PER_KEY // 64)
    return min(MOST_WORDS, 1 << (needed - 1).bit_length())


def _bits(columns: list[str], words: int) -> tuple[str, str]:
    """SQL text of a row's word and of its bits there."""
    key = f"xxhash64({', '.join(columns)}, 'filter')"
    bits = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned({key}, {6 * i}) & 63 as int))"
                      for i in range(4))
    return f"shiftrightunsigned({key}, 24) & {words - 1}", bits


def key_filter(keys: DataFrame, columns: list[str], words: int) -> DataFrame:
    """(_word, _mask): the filter of the keys, at most `words` rows."""
    word, bits = _bits(columns, words)
    return (keys.selectExpr(f"{word} as _word", f"{bits} as _bits")
            .groupBy("_word").agg(F.expr("bit_or(_bits) as _mask")))


def _tested(rows: DataFrame, keys: DataFrame, columns: list[str], words: int | None, how: str
            ) -> DataFrame:
    words = words or words_for(keys.count())
    word, bits = _bits(columns, words)
    held = key_filter(keys, columns, words)
    return rows.join(F.broadcast(held), F.expr(
        f"_word = ({word}) and (_mask & ({bits})) = ({bits})"), how)


def may_match(rows: DataFrame, keys: DataFrame, columns: list[str], words: int | None = None
              ) -> DataFrame:
    """The rows whose columns may be those of a row of `keys`, by a map-side test.

    `words` is a power of two; without it the keys are counted first.
    """
    return _tested(rows, keys, columns, words, "left_semi")


def may_not_match(rows: DataFrame, keys: DataFrame, columns: list[str], words: int | None = None
                  ) -> DataFrame:
    """The rows that `may_match` leaves out: none of them has a partner in `keys`."""
    return _tested(rows, keys, columns, words, "left_anti")

"""Operator 1: quality rules with adaptive thresholds from mergeable quantile sketches.

A sketch of a rate is its counts by bucket: whole numbers below 64 each have a bucket, above that a
bucket spans a 32nd of its value, so a quantile is right within 3 percent, whatever the number of
documents. Sketches are sums of counts: they are filled map-side, merged by adding, and never depend
on order or partitioning. There is one per language, source and rate; groups of fewer than
`MIN_GROUP` documents use the merged sketch of their language, and languages with fewer use that of
all documents.

For each rate the fence lies beyond the outer tenth by `REACH` times the distance from the median to
that tenth, plus a least width, so what is common in a source is never rejected there. The fences are
joined to the documents by a join that splits groups of any share.

Rates: symbols per 1,000 word characters, repeated lines per 1,000 lines with a word, word characters
per 100 words. Documents that fail the base rule do not enter the sketches.

Null or empty text: no words, fails. Null language or source: a group of its own. Repeated rows are
judged one by one. Extra columns are ignored; an empty table gives no rows. Two 5-word windows are
held equal if their 64-bit hashes are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitwise.llm.common import land, pick
from remitwise.operators.skew import spread_join

MIN_GROUP = 100
REACH = 3
# rate: (expression, least width of its fence, whether it has a lower fence)
RATES = {
    "symbol_rate": ("n_symbols * 1000 div word_chars", 40, False),
    "dup_line_rate": ("n_dup_lines * 1000 div n_lines", 400, False),
    "word_size": ("word_chars * 100 div n_words", 200, True),
}
GAPS = r"[\x20\x09-\x0D]+"


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every whole text."""
    rows = pick(docs, "doc_id", "lang", "source", "text").selectExpr(
        "doc_id", "lang", "source", "coalesce(text, '') as text")
    words = rows.selectExpr(
        "*", f"array_remove(split(text, r'{GAPS}'), '') as w",
        r"filter(split(text, '\n'), x -> x rlike r'[^\x20\x09-\x0D]') as lines")
    window = ", ".join(f"get(w, i + {k})" for k in range(5))
    counted = words.selectExpr(
        "doc_id", "lang", "source", "cast(size(w) as bigint) as n_words",
        "cast(length(array_join(w, '')) as bigint) as word_chars",
        "cast(regexp_count(text, '[#*$%&|<>]') as bigint) as n_symbols",
        "cast(size(lines) as bigint) as n_lines",
        "cast(size(lines) - size(array_distinct(lines)) as bigint) as n_dup_lines",
        f"if(size(w) < 5, cast(array() as array<bigint>), "
        f"transform(sequence(0, size(w) - 5), i -> xxhash64({window}))) as h")
    # Most texts repeat no window: only the others are sorted.
    ranked = counted.selectExpr(
        "* except (h)", "if(size(array_distinct(h)) = size(h), "
        "cast(array() as array<struct<h: bigint, i: int>>), "
        "array_sort(transform(h, (x, i) -> struct(x as h, i as i)))) as s")
    placed = ranked.selectExpr(
        "* except (s)", "array_sort(transform(filter(s, (e, k) -> get(s, k - 1).h <=> e.h or "
        "get(s, k + 1).h <=> e.h), e -> e.i)) as p")
    return placed.selectExpr(
        "* except (p)", "cast(if(size(p) = 0, 0, 5 + if(size(p) = 1, 0, aggregate("
        "sequence(1, size(p) - 1), 0, (a, k) -> a + least(5, get(p, k) - get(p, k - 1)))))"
        " as bigint) as n_repeat_words")


def bucket(value: str) -> str:
    """Bucket of a whole number of at least 0."""
    shift = f"greatest(length(bin({value})) - 6, 0)"
    return f"32 * {shift} + shiftright({value}, {shift})"


def top(number: str) -> str:
    """Largest value of a bucket."""
    shift = f"greatest({number} div 32 - 1, 0)"
    return f"shiftleft({number} - 32 * {shift} + 1, cast({shift} as int)) - 1"


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, rate, bucket, n) of the documents that pass the base rule."""
    pairs = ", ".join(f"struct('{r}' as rate, {e} as value)" for r, (e, _, _) in RATES.items())
    return (measured.filter("not base_failed").selectExpr(
        "lang", "source", f"inline(array({pairs}))")
        .selectExpr("lang", "source", "rate", f"cast({bucket('value')} as bigint) as bucket")
        .groupBy("lang", "source", "rate", "bucket").agg(F.expr("count(*) as n")))


def fences(sketch: DataFrame, *keys: str) -> DataFrame:
    """Fences of each group of `keys`: sketches are merged, then read off."""
    merged = sketch.groupBy(*keys, "rate", "bucket").agg(F.expr("sum(n) as n"))
    group = ", ".join([*keys, "rate"])
    ranked = merged.selectExpr(
        *keys, "rate", "bucket", f"sum(n) over (partition by {group} order by bucket) as below",
        f"sum(n) over (partition by {group}) as total")
    read = ranked.groupBy(*keys, "rate").agg(F.expr("max(total) as total"), *[
        F.expr(f"min(if(below * 100 >= total * {p}, {top('bucket')}, null)) as q{p}")
        for p in (10, 50, 90)])
    columns = []
    for rate, (_, width, both) in RATES.items():
        columns.append(f"max(if(rate = '{rate}', q90 + {REACH} * (q90 - q50) + {width}, null))"
                       f" as {rate}_hi")
        if both:
            columns.append(f"max(if(rate = '{rate}', q10 - {REACH} * (q50 - q10) - {width}, null))"
                           f" as {rate}_lo")
    return read.groupBy(*keys).agg(F.expr("max(total) as total"), *map(F.expr, columns))


def thresholds(measured: DataFrame) -> DataFrame:
    """Fences for every (lang, source) of the documents, with its number of documents."""
    sketch = land(sketches(measured), "sketches")
    names = [f"{r}_hi" for r in RATES] + [f"{r}_lo" for r, (_, _, both) in RATES.items() if both]

    def named(df: DataFrame, prefix: str, *keys: str) -> DataFrame:
        return df.selectExpr(*[f"{k} as {prefix}_{k}" for k in keys], f"total as {prefix}_total",
                             *[f"{n} as {prefix}_{n}" for n in names])

    groups = measured.groupBy("lang", "source").agg(F.expr("count(*) as docs"))
    own = named(fences(sketch, "lang", "source"), "own", "lang", "source")
    wide = named(fences(sketch, "lang"), "wide", "lang")
    every = named(fences(sketch.selectExpr("*", "0 as one"), "one"), "every", "one")
    joined = (groups.selectExpr("*", "0 as one")
              .join(own, F.expr("lang <=> own_lang and source <=> own_source"), "left")
              .join(wide, F.expr("lang <=> wide_lang"), "left")
              .join(every, F.expr("one = every_one"), "left"))
    return joined.selectExpr("lang", "source", "docs", *[
        f"case when own_total >= {MIN_GROUP} then own_{n} "
        f"when wide_total >= {MIN_GROUP} then wide_{n} else every_{n} end as {n}" for n in names])


def judge(docs: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Counts, base_failed and kept of every document, with the fences it was held to."""
    measured = land(measures(docs).selectExpr(
        "*", "n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed"), "measures")
    fenced = spread_join(measured, thresholds(measured), ["lang", "source"], "docs", "doc_id",
                         rows_per_task, null_keys=True)
    inside = " and ".join(
        [f"{e} <= {r}_hi" for r, (e, _, _) in RATES.items()]
        + [f"{e} >= {r}_lo" for r, (e, _, both) in RATES.items() if both])
    return fenced.selectExpr(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", f"if(base_failed, false, {inside}) as kept")

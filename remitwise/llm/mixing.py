"""Operator 2: mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size is the expected number of copies of each of its documents. The
whole part is taken outright; the rest is a probability in units of 1 / `UNIT`. Documents meet in
blocks of at most about `BLOCK` of one source and of similar size. Along a block pairs are formed and
mass is transferred at random until one of the two is integral (none or a full copy), so the mass of
the block is preserved exactly and at most one document of a block is left fractional. Those go on to
the next level of the tree as the documents of larger blocks, until a source has one block; its last
fraction is rounded at random. Each document's expected copies are kept at every step, and since
partners have similar sizes, the words of a source stay near its target.

Draws come from hashes of seed, ids and level, so reruns agree. Targets: all sizes are shared by
weight; a source whose share is above `CAP` times its size gets that, and what is left is shared by
the others, until none is above.

Null text or no words: size 0, nothing taken. Null source: a source of its own, last in order.
Repeated rows are separate documents. Sources
without words have the target 0. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitwise.llm.common import land, pick
from remitwise.operators.skew import spread_join

WEIGHTS = (5, 2, 1)
CAP = 3
UNIT = 1 << 30
BLOCK = 64
GAPS = r"[\x20\x09-\x0D]+"


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, text_hash, size, copy): words of every text.

    `copy` tells the rows of one doc_id apart, equal ones too.
    """
    rows = pick(docs, "doc_id", "source", "text").selectExpr(
        "doc_id", "source", "xxhash64(text) as text_hash",
        f"cast(size(array_remove(split(coalesce(text, ''), r'{GAPS}'), '')) as bigint) as size")
    # Counting first keeps a row that is repeated without end out of any one task.
    counted = rows.groupBy("doc_id", "source", "text_hash", "size").agg(F.expr("count(*) as rows"))
    return counted.selectExpr("*", "explode(sequence(1L, rows)) as nth").selectExpr(
        "doc_id", "source", "text_hash", "size", "xxhash64(source, text_hash, size, nth) as copy")


def ranked(groups: DataFrame, key: str) -> DataFrame:
    """Add `place`, the row's number in the order of `key`, nulls last, without one task sorting all."""
    ordered = groups.orderBy(F.col(key).asc_nulls_last()).selectExpr(
        "*", "spark_partition_id() as part", "monotonically_increasing_id() & 8589934591 as nth")
    ordered = land(ordered, "ranked")
    # One row per partition.
    starts = ordered.groupBy("part").agg(F.expr("count(*) as rows")).selectExpr(
        "part", "sum(rows) over (order by part) - rows as before")
    return ordered.join(starts, "part").selectExpr("* except (part, nth, before)",
                                                   "before + nth as place")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, docs, target) of every source."""
    sources = sized.groupBy("source").agg(F.expr("sum(size) as source_size"),
                                          F.expr("count(*) as docs"))
    arms = " ".join(f"when {i} then {w}" for i, w in enumerate(weights))
    weighed = land(ranked(sources, "source").selectExpr(
        "source", "source_size", "docs",
        f"case place % {len(weights)} {arms} end as weight"), "sources")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, known = 0.0, -1
    while True:
        # A source is full if its share at this level is more than it may give.
        full = f"weight * double('{level!r}') > {cap} * source_size"
        held, left, count = weighed.selectExpr(
            f"coalesce(sum(if({full}, {cap} * source_size, 0)), 0)",
            f"coalesce(sum(if({full}, 0, weight)), 0)", f"count_if({full})").first()
        if count == known or not left:
            break
        level, known = (total - held) / left, count
    return weighed.selectExpr(
        "source", "source_size", "docs",
        f"least(cast({cap} * source_size as double), weight * double('{level!r}')) as target")


# One pivotal step: `a` holds the open document so far, `x` is the next one. Of two masses that fit
# into one copy one document gets both; otherwise one gets a full copy and the other the rest.
_DRAW = "pmod(xxhash64(a.open.doc_id, a.open.copy, x.doc_id, x.copy, {seed}, {level}), {span})"
_STEP = """
named_struct(
  'open', case
    when a.open is null then x
    when a.open.mass + x.mass <= {unit} then if({share} < a.open.mass,
      named_struct('doc_id', a.open.doc_id, 'copy', a.open.copy, 'mass', a.open.mass + x.mass,
                   'size', a.open.size),
      named_struct('doc_id', x.doc_id, 'copy', x.copy, 'mass', a.open.mass + x.mass,
                   'size', x.size))
    when {excess} < {unit} - x.mass then
      named_struct('doc_id', x.doc_id, 'copy', x.copy, 'mass', a.open.mass + x.mass - {unit},
                   'size', x.size)
    else named_struct('doc_id', a.open.doc_id, 'copy', a.open.copy,
                      'mass', a.open.mass + x.mass - {unit}, 'size', a.open.size) end,
  'full', case
    when a.open is null or a.open.mass + x.mass <= {unit} then a.full
    when {excess} < {unit} - x.mass then
      array_append(a.full, named_struct('doc_id', a.open.doc_id, 'copy', a.open.copy))
    else array_append(a.full, named_struct('doc_id', x.doc_id, 'copy', x.copy)) end)
"""


def _pivoted(blocks: DataFrame, level: int, seed: int, unit: int) -> DataFrame:
    share = _DRAW.format(seed=seed, level=level, span="a.open.mass + x.mass")
    excess = _DRAW.format(seed=seed, level=level, span=f"2L * {unit}L - a.open.mass - x.mass")
    step = _STEP.format(unit=f"{unit}L", share=share, excess=excess)
    fields = blocks.schema["docs"].dataType.elementType
    entry = fields.simpleString()
    key = f"struct<doc_id: {fields['doc_id'].dataType.simpleString()}, copy: bigint>"
    return blocks.selectExpr(
        "source", f"aggregate(docs, named_struct('open', cast(null as {entry}), "
                  f"'full', cast(array() as array<{key}>)), (a, x) -> {step}) as done")


def rounded(masses: DataFrame, seed: int = 0, block: int = BLOCK, unit: int = UNIT) -> DataFrame:
    """(doc_id, copy) of the documents that get one more copy.

    `masses` has (doc_id, copy, source, size, mass), the mass below `unit`.
    """
    taken: list[DataFrame] = []
    open_docs, level = masses.filter("mass > 0"), 0
    while True:
        counts = open_docs.groupBy("source").agg(F.expr("count(*) as docs"))
        # Blocks of similar sizes: classes an eighth apart, cut at random into enough blocks, until
        # all that is left of a source fits one block.
        bits = "length(bin(size))"
        kind = f"if(docs <= {block}, 0, 8 * {bits} + shiftright(shiftleft(size, 3), {bits} - 1))"
        spread = spread_join(open_docs, counts, ["source"], "docs", "doc_id", null_keys=True)
        classed = spread.selectExpr(
            "doc_id", "copy", "source", "size", "mass", "docs",
            f"cast({kind if level < 2 else 0} as bigint) as kind")
        per_class = classed.groupBy("source", "kind").agg(F.expr("count(*) as members"))
        cut = spread_join(classed, per_class, ["source", "kind"], "members", "doc_id",
                          null_keys=True)
        blocks = cut.selectExpr(
            "source", "kind", f"pmod(xxhash64(doc_id, copy, {seed}, {level}), "
            f"(members - 1) div {block} + 1) as block",
            "struct(size as by_size, xxhash64(doc_id, copy) as by_hash, doc_id, copy, mass, size)"
            " as doc").groupBy("source", "kind", "block").agg(
            F.expr("transform(array_sort(collect_list(doc)), "
                   "d -> struct(d.doc_id, d.copy, d.mass, d.size)) as docs"))
        done = land(_pivoted(blocks, level, seed, unit), f"pivot{level}")
        taken.append(done.selectExpr("inline(done.full)"))
        taken.append(done.filter(f"done.open.mass = {unit}").selectExpr(
            "done.open.doc_id", "done.open.copy"))
        rest = done.filter(f"done.open.mass < {unit} and done.open.mass > 0").selectExpr(
            "done.open.doc_id", "done.open.copy", "source", "done.open.size", "done.open.mass")
        left, sources = rest.selectExpr(
            "count(*)", "count(distinct struct(source))").first()
        if left == sources:
            # One document per source: its fraction is rounded by a draw.
            taken.append(rest.filter(
                f"pmod(xxhash64(doc_id, copy, {seed}, -1), {unit}) < mass").select("doc_id", "copy"))
            break
        open_docs, level = rest, level + 1
    out = taken[0]
    for more in taken[1:]:
        out = out.unionByName(more)
    return out


def mix(docs: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP,
        block: int = BLOCK) -> DataFrame:
    """(doc_id, source, text_hash, copy, size, source_size, target, copies) of every row."""
    sized = land(sizes(docs), "sizes")
    goals = land(targets(sized, weights, cap), "targets")
    rate = "if(source_size = 0, 0D, target / source_size)"
    planned = spread_join(sized, goals, ["source"], "docs", "doc_id", null_keys=True).selectExpr(
        "doc_id", "copy", "source", "text_hash", "size", "source_size", "target",
        f"cast(round({rate} * {UNIT}) as bigint) as mass")
    planned = land(planned, "planned")
    more = rounded(planned.selectExpr("doc_id", "copy", "source", "size", f"mass % {UNIT} as mass")
                   .filter("size > 0"), seed, block)
    one = more.selectExpr("doc_id as m_doc", "copy as m_copy")
    return planned.join(one, F.expr("doc_id <=> m_doc and copy = m_copy"), "left").selectExpr(
        "doc_id", "copy", "source", "text_hash", "size", "source_size", "target",
        f"mass div {UNIT} + if(m_copy is null, 0, 1) as copies")


def taken_words(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    return mix(docs).selectExpr("doc_id", "size", "source_size", "target", "copies * size as taken")


def mixed(docs: DataFrame, seed: int = 0) -> DataFrame:
    """All columns of the documents as often as the mix takes them."""
    plan = (mix(docs, seed).groupBy("doc_id", "source", "text_hash")
            .agg(F.expr("sum(copies) as total")).filter("total > 0")
            .toDF("plan_id", "plan_source", "plan_hash", "plan_total"))
    columns = [f"_{i}" for i in range(len(docs.columns))]
    at = {name: columns[docs.columns.index(name)] for name in ("doc_id", "source", "text")}
    keys = ["plan_id", "plan_source", "plan_hash"]
    return (docs.toDF(*columns).withColumn("own_hash", F.xxhash64(at["text"]))
            .join(plan, F.expr(f"{at['doc_id']} <=> plan_id and {at['source']} <=> plan_source "
                               "and own_hash = plan_hash"))
            .dropDuplicates(keys)
            .selectExpr(*columns, "explode(sequence(1L, plan_total)) as nth")
            .select(*columns).toDF(*docs.columns))

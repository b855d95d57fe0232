"""Operator 8: URL filters by a blocked Bloom filter and an exact join.

A rule is a host and a path prefix, written as one canonical string (`example.net/en/`). It fits its
host, all subdomains, and every path that starts with its path; the longest fitting rule decides
(then the longer host, then block before allow). A url is therefore looked up under each suffix of
its host with each prefix of its path that has the length of some rule's path.

The filter holds the rules: 256-bit blocks, one bit in each of a block's four words. It has at most
`FILTER_WORDS` words whatever the number of rules, so it may go to every task; a fuller filter only
passes more false hits. What it passes is grouped by its list of hits, the lists are joined with the
rules exactly, and the outcome goes back to the urls by a join that splits common lists. Urls without
a hit, the most, take no part in any shuffle.

Null url or no `://`: empty host and path, no rule. No fitting rule: `allow`. Repeated rows are kept,
extra columns ignored, an empty table gives no rows. Path lengths of rules go through the driver:
distinct integers, at most as many as a path has characters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitwise.llm.common import pick
from remitwise.operators.skew import spread_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FILTER_WORDS = 1 << 20
BITS_PER_RULE = 16

# Fixed values of the contract.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
         ("org/fr/", "allow")]


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "rule string, verdict string")


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, host, path) of every url."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return pick(pages, "page_id", "url").selectExpr(
        "page_id",
        f"translate(coalesce(regexp_extract(url, r'{pattern}', 1), ''), '{UPPER}', '{LOWER}') as host",
        f"coalesce(regexp_extract(url, r'{pattern}', 2), '') as path")


def _bits(key: str) -> list[str]:
    return [f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({key}, 1), {6 * i}) & 63 as int))"
            for i in range(4)]


def bloom(rules: DataFrame, blocks: int) -> DataFrame:
    """One row with the words of the filter."""
    words = [f"bit_or({bit}) as w{i}" for i, bit in enumerate(_bits("rule"))]
    filled = rules.selectExpr(f"pmod(xxhash64(rule), {blocks}) as block", "rule").groupBy(
        "block").agg(*map(F.expr, words))
    every = rules.sparkSession.range(blocks).selectExpr("id as block").join(filled, "block", "left")
    return every.selectExpr(
        "struct(block, array(" + ", ".join(f"coalesce(w{i}, 0L)" for i in range(4)) + ") as w) as b"
    ).agg(F.expr("flatten(transform(array_sort(collect_list(b)), x -> x.w)) as words"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow",
          rows_per_task: int | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page; `rules` has (rule, verdict)."""
    rules = (pick(rules, "rule", "verdict")
             .filter("instr(rule, '/') > 1")
             .selectExpr(f"concat(translate(substring_index(rule, '/', 1), '{UPPER}', '{LOWER}'), "
                         "substr(rule, instr(rule, '/'))) as rule", "verdict",
                         "instr(rule, '/') - 1 as host_size")
             # Block is the larger word: of two verdicts on one rule it wins.
             .groupBy("rule", "host_size").agg(F.max("verdict").alias("verdict")))
    lengths = [r[0] for r in rules.selectExpr("length(rule) - host_size").distinct().collect()]
    blocks = max(1, min(rules.count() * BITS_PER_RULE // 256 + 1, FILTER_WORDS // 4))
    listed = "array(" + ", ".join(map(str, sorted(lengths))) + ")" if lengths else (
        "cast(array() as array<int>)")
    suffixes = ("transform(sequence(1, size(split(host, '[.]'))), "
                "i -> array_join(slice(split(host, '[.]'), i, 1000000), '.'))")
    keys = (f"flatten(transform(filter({suffixes}, s -> s <> ''), s -> transform("
            f"filter({listed}, n -> n <= length(path)), n -> concat(s, substr(path, 1, n)))))")
    passes = " and ".join(
        f"(get(words, cast(pmod(xxhash64(k), {blocks}) as int) * 4 + {i}) & {bit}) <> 0"
        for i, bit in enumerate(_bits("k")))
    looked_up = (parsed(pages).withColumn("words", bloom(rules, blocks).scalar())
                 .selectExpr("page_id", "host", "path", f"filter({keys}, k -> {passes}) as hits"))

    found = looked_up.filter("size(hits) > 0")
    lists = found.groupBy("hits").agg(F.expr("count(*) as urls"))
    best = (lists.selectExpr("hits", "urls", "explode(hits) as rule").join(rules, "rule", "left")
            .groupBy("hits", "urls").agg(F.expr(
                "max(if(verdict is null, null, struct(length(rule) as n, host_size, rule, verdict)))"
                " as best")))
    joined = spread_join(found, best, ["hits"], "urls", "page_id", rows_per_task)
    rest = looked_up.filter("size(hits) = 0").selectExpr(
        "page_id", "host", "path", "cast(null as string) as rule", f"'{default}' as verdict")
    return joined.selectExpr(
        "page_id", "host", "path", "best.rule as rule",
        f"coalesce(best.verdict, '{default}') as verdict").unionByName(rest)

"""The filter of join keys."""

from __future__ import annotations

from rows import PARAMS, claim, feeds, remit

from remitwise import fixture
from remitwise.operators.bloom import MOST_WORDS, key_filter, may_match, may_not_match, words_for
from remitwise.operators.checks import dq02, dq03, dq04
from remitwise.operators.layers import build_layer


def written(df):
    """Rows that the exchanges of a plan that ran have written."""
    plan, total, todo = df._jdf.queryExecution().executedPlan(), 0, []
    df.collect()
    todo.append(plan)
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name in ("ShuffleQueryStage", "BroadcastQueryStage"):
            todo.append(node.plan())
            continue
        if name == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_no_key_is_lost_and_few_others_pass(spark):
    keys = spark.range(0, 200_000, 100).selectExpr("concat('k', id) as k", "id as other")
    rows = spark.range(200_000).selectExpr("concat('k', id) as k", "id")
    passed = may_match(rows, keys, ["k"])
    assert passed.join(keys, "k", "left_semi").count() == 2000
    assert passed.count() < 2000 + 0.05 * 200_000
    assert passed.columns == ["k", "id"]
    others = may_not_match(rows, keys, ["k"])
    assert others.count() + passed.count() == 200_000 and not others.join(keys, "k").count()


def test_a_full_filter_passes_everything(spark):
    keys, rows = spark.range(10_000), spark.range(20_000)
    assert key_filter(keys, ["id"], 1).first()._mask == -1
    assert may_match(rows, keys, ["id"], 1).count() == 20_000


def test_empty_keys_nulls_and_bounds(spark):
    rows = spark.createDataFrame([(1,), (None,)], "id bigint")
    assert may_match(rows, rows.filter("id > 5"), ["id"]).count() == 0
    assert may_match(rows, rows, ["id"]).count() == 2
    assert words_for(0) == 1 and words_for(10**12) == MOST_WORDS
    assert words_for(1000) == 256


def test_few_lines_and_claims_reach_an_exchange(spark):
    """One line in a hundred has a fact; the join sees little more than those lines."""
    claims, remits = feeds(
        spark, [claim(i, patient_id=f"P{i}") for i in range(3000)],
        [remit(i) for i in range(3000)] + [remit(i, remit_id=f"X{i}") for i in range(0, 3000, 200)])
    layer = build_layer(spark, claims, remits, fixture.payers(spark))
    assert layer.flagged.count() == 30
    facts = layer.grain.filter("remit_line_count > 1").select("claim_id")
    passed = may_match(layer.remits, facts, ["claim_id"])
    assert written(passed) < 0.05 * 3015
    assert dq03(layer, PARAMS).count() == 15 and dq04(layer, PARAMS).count() == 0
    assert dq02(layer, PARAMS).count() == 0

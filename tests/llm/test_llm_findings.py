"""Places where the operators once did less than the whole job."""

import random

import pytest

import corpus_pipeline
from remitwise.llm import neardup, surrogates
from remitwise.llm.common import land
from test_bloom import written
from test_llm_text import SCHEMA


def test_near_duplicates_have_ten_trees():
    assert neardup.plan(85).trees >= 10


@pytest.mark.parametrize("similar", [80, 85])
def test_trees_hold_their_recall_at_every_depth(similar):
    """Drawn anew: how often a pair of exactly this similarity is parted, against the computed chance."""
    own, draw, runs = neardup.plan(similar), random.Random(6), 4000

    def parted(level, used):
        if level == neardup.MOST_DEPTH:
            return False
        more = own.more if level < neardup.LEAST_DEPTH else own.deep
        free = [c for c in range(neardup.OWN) if c not in used]
        chosen = draw.sample(free, 1 + (draw.randrange(1000) < more))
        return all(not same[c] or parted(level + 1, used | {c}) for c in chosen)

    lost = 0
    for _ in range(runs):
        same = [draw.randrange(100) < similar for _ in range(neardup.OWN)]
        lost += parted(0, frozenset())
    miss = neardup.tree_miss(similar, own.more, own.deep, neardup.MOST_DEPTH)
    assert lost / runs == pytest.approx(miss, abs=0.03)
    assert miss ** own.trees <= neardup.MISSED
    assert own.trees >= neardup.LEAST_TREES


def test_pairs_in_a_large_family(spark):
    """10,400 texts share a passage, 2,600 pairs of them are just similar enough."""
    draw = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(66))
    values = []
    for i in range(7800):
        own = [f"{i}x{j}" for j in range(38)]
        values.append(f"{passage} {' '.join(own)}")
        if i < 2600:
            at = draw.randrange(6, 28)
            own[at], own[at + 3] = "y", "z"
            values.append(f"{passage} {' '.join(own)}")
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(values)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in got} == {
        i: i - i % 2 if i < 5200 else i for i in range(len(values))}


def test_stage_links_from_eighty_percent(spark):
    """54 of 66 shingles, 0.82, are common to the first two; 51 of 69, 0.74, to the first and last."""
    words = [f"w{i}" for i in range(64)]
    near, far = list(words), list(words)
    near[20], near[21] = "a", "b"
    far[20], far[24] = "c", "d"
    rows = [(i, " ".join(w), "en", "s", 0) for i, w in enumerate([words, near, far])]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == [0, 2]
    assert neardup.near_duplicates(docs).filter("kept").count() == 3


@pytest.mark.parametrize("text, kinds", [
    ("+1 (826) 555-4081 190.137.223.204", ["phone", "ip"]),
    ("+1 (743) 555-3824 4845168114407329", ["phone", "card"]),
    ("(743) 555-3824 4845 1681 1440 7329", ["phone", "card"]),
    ("+1 (743) 555-3824 5 men", ["phone"]), ("743-555-3824 5 men", ["phone"]),
    ("12 4845 1681 1440 7329", ["card"]), ("10 190.137.223.204", ["ip"]),
    ("+1 (743) 555-3824-55, +1 (743) 555-38245", [])])
def test_phones_before_digits(text, kinds):
    assert [e[0] for e, _, _ in surrogates.find(text)] == kinds


@pytest.mark.parametrize("text, normal", [
    ("+14155550123", "+1-14155550123"), ("+1 (415) 555-0123", "+1-14155550123"),
    ("+33 1 23 45 67 89 5 men", "+33-33123456789"), ("+49 30 1234567", "+49-49301234567"),
    ("+353871234567 10.1.2.3", "+353-353871234567")])
def test_international_phones(text, normal):
    entity, begin, end = surrogates.find(text)[0]
    assert entity == ("phone", normal)
    own = surrogates.spelled(entity, surrogates.surrogate(b"k", *entity, 0), text[begin:end])
    code = normal.split("-")[0]
    assert own.startswith(code) and own != text[begin:end] and len(own) == end - begin


def test_a_cluster_is_one_row(spark):
    """Nodes of several trees that hold the same family give equal rows, compared in full once."""
    words = [f"w{i}" for i in range(300)]
    docs = spark.createDataFrame(
        [(n, " ".join([*words, f"x{n}"])) for n in range(60)] + [(99, "a b c d e f g")],
        "doc_id bigint, text string")
    own = neardup.plan(80)
    members = land(neardup.signatures(docs, own).selectExpr(
        "fp", "doc_id as rep", "n_shingles", "sig"), "members")
    nodes = members.selectExpr("explode(sequence(1L, 12L)) as node", "fp")
    found = neardup.clusters(nodes, members, own).collect()
    assert len(found) == 12 and len({tuple(row.fps) for row in found}) == 1
    assert len(found[0].fps) == 60
    again = neardup.links(neardup.clusters(nodes, members, own), members, docs, 80)
    assert again.count() == 59


def test_signatures_are_narrow_and_only_grouped_members_are_shuffled(spark):
    """Two of 2,000 members share a node: little more than these two reach an exchange."""
    docs = spark.range(2000).selectExpr(
        "id as doc_id", "concat_ws(' ', transform(sequence(1, 30), i -> concat('w', id div 2, 'x', i))) as text")
    own = neardup.plan(85)
    signed = neardup.signatures(docs, own)
    assert signed.schema["sig"].dataType.elementType.simpleString() == "smallint"
    # The document ids stand for the fingerprints, so that equal texts are two members.
    members = land(signed.selectExpr("cast(cast(doc_id as string) as binary) as fp", "doc_id as rep",
                                     "n_shingles", "sig"), "members")
    nodes = members.filter("rep < 2").selectExpr("7L as node", "fp")
    found = neardup.clusters(nodes, members, own)
    assert written(found) < 100
    assert [sorted(r.fps) for r in found.collect()] == [[b"0", b"1"]]

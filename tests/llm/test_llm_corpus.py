"""Operators over whole tables against brute force, and the pipeline."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from remitwise.llm import mixing, neardup, topk, urls
from test_llm_text import SCHEMA


def shingles(text):
    words = (text or "").lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(2)
    base = [" ".join(f"w{draw.randrange(400)}" for _ in range(draw.randint(1, 120)))
            for _ in range(60)]
    values = [None, "", " \n", "a b", "A  B", *base, *base[:10]]
    # One large group of near copies, some of them too far from the first one.
    for i in range(300):
        words = base[0].split() + base[1].split() + base[2].split() + base[3].split()
        for _ in range(draw.randint(0, 3)):
            words[draw.randrange(len(words))] = f"x{i}"
        values.append(" ".join(words))
    return [(i, t, "en", f"s{i % 4}" if i % 9 else None, 0) for i, t in enumerate(values)]


@pytest.mark.parametrize("leaf, block", [(128, 512), (8, 16)])
def test_near_duplicates_by_brute_force(spark, corpus, monkeypatch, leaf, block):
    monkeypatch.setattr(neardup, "LEAF", leaf)
    monkeypatch.setattr(neardup, "BLOCK", block)
    sets = {i: shingles(t) for i, t, *_ in corpus}
    label = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids[:ids.index(a)]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    frame = spark.createDataFrame(corpus, SCHEMA).withColumn("N_Shingles", F.lit(1))
    got = neardup.near_duplicates(frame).collect()
    assert {r.doc_id: (r.component_id, r.n_shingles, r.kept) for r in got} == {
        i: (label[i], len(sets[i]), label[i] == i) for i in ids}


def test_mixing_keeps_its_targets(spark, corpus):
    frame = spark.createDataFrame(corpus, SCHEMA)
    rows = mixing.mix(frame, block=8).collect()
    again = mixing.mix(frame.repartition(5), block=8).collect()
    assert sorted((r.doc_id, r.copies) for r in rows) == sorted((r.doc_id, r.copies) for r in again)
    assert len(rows) == len(corpus) and all(0 <= r.copies <= 3 for r in rows)
    sources = {r.source: (r.source_size, r.target) for r in rows}
    order = sorted(sources, key=lambda s: (s is None, s))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    # Water is filled by bisection here.
    total, low, high = sum(s for s, _ in sources.values()), 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        filled = sum(min(3 * sources[s][0], weights[s] * level) for s in order)
        low, high = (level, high) if filled < total else (low, level)
    for s in order:
        assert sources[s][1] == pytest.approx(min(3 * sources[s][0], weights[s] * low), rel=1e-6)
        biggest = max(r.size for r in rows if r.source == s)
        taken = sum(r.size * r.copies for r in rows if r.source == s)
        assert abs(taken - sources[s][1]) <= 3 * biggest
    assert mixing.taken_words(frame.limit(0)).count() == 0


def test_top_k_with_ties_and_gaps(spark):
    draw = random.Random(4)
    rows = [(i, [draw.choice([0.1, -0.2, 0.5]) for _ in range(6)]) for i in range(200)]
    rows += [(200, None), (201, [None] * 6), (202, [float("nan")] * 6), (220, [0.3, 0.1]),
             (240, []), (None, [0.1] * 6)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {}
    for r in topk.top_k(frame, query_block=4, candidate_block=40).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    valid = {r.vec_id: [int(x) for x in r.v] for r in topk.vectors(frame).selectExpr(
        "vec_id", "transform(v, x -> floor(x)) as v").collect()}
    for q in [i for i in valid if i % 20 == 0]:
        best = sorted((-sum(a * b for a, b in zip(valid[q], v)), i) for i, v in valid.items()
                      if i != q and len(v) == len(valid[q]))[:20]
        assert sorted(got.get(q, [])) == [(n, i, -s) for n, (s, i) in enumerate(best, 1)]


def brute_force(rows, k=20):
    """Ranked candidates of each query id, by integers; rows of one id are ranked together."""
    valid = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for i, q in valid:
        if i % 20 == 0:
            out.setdefault(i, []).extend(
                (-sum(a * b for a, b in zip(q, v)), j) for j, v in valid if j != i and len(v) == len(q))
    return {i: [(n, j, -s) for n, (s, j) in enumerate(sorted(found)[:k], 1)]
            for i, found in out.items() if found}


def top_k_of(spark, rows, **kw):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in topk.top_k(frame, **kw).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {i: sorted(found) for i, found in got.items()}


def clustered(n, size=16, clusters=12, seed=7):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(clusters, size)).repeat(8, axis=1)
    return centres[draw.integers(0, clusters, n)] + 0.05 * draw.normal(size=(n, size * 8))


def test_top_k_of_clusters_random_and_equal_vectors(spark):
    draw = np.random.default_rng(3)
    for made in (clustered(600), draw.normal(size=(500, 64)), np.ones((300, 9)),
                 np.repeat(draw.normal(size=(40, 5)), 8, axis=0)):
        rows = [(i, v.tolist()) for i, v in enumerate(made)]
        assert top_k_of(spark, rows, query_block=16, candidate_block=50) == brute_force(rows)


def test_top_k_of_odd_rows(spark):
    draw = random.Random(5)
    base = [(i, [draw.uniform(-1, 1) for _ in range(10)]) for i in range(120)]
    # Repeated ids, queries among them, with the same vector and with another.
    rows = [*base, base[20], base[21], (40, base[41][1]), (None, base[0][1]), (400, None),
            (420, [1.0, None]), (440, [float("inf")] * 10), (460, []), (461, []), (480, [1e300] * 3)]
    assert top_k_of(spark, rows, query_block=8, candidate_block=30) == brute_force(rows)
    assert top_k_of(spark, rows[:1]) == {} and top_k_of(spark, [(20, None)]) == {}
    large = [(i, [float(draw.randrange(1 << 24)) for _ in range(3)]) for i in range(60)]
    assert top_k_of(spark, large, candidate_block=20) == brute_force(large)
    clash = spark.createDataFrame([(i, v, 1) for i, v in base], "vec_id bigint, embedding array<double>, "
                                  "VEC_ID int")
    assert topk.top_k(clash).count() == 120


def test_top_k_prunes_pairs_and_blocks(spark):
    made = np.floor(64 * clustered(4000))
    alive = np.ones((100, 4000), bool)
    alive[np.arange(100), np.arange(100)] = False
    *_, left = topk.best(made[:100], made, alive, np.full(100, -np.inf), np.arange(4000), 20)
    assert left[0] == 100 * 3999 and left == sorted(left, reverse=True)
    assert left[2] < 0.3 * left[0] and left[-1] < 0.05 * left[0]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(made / 64)],
                                  "vec_id bigint, embedding array<double>")
    rows = topk.blocked(topk.summarised(topk.vectors(frame)), 100, "block").cache()
    asked = topk.envelopes(rows.withColumnRenamed("block", "query_block"), "query_block")
    blocks = topk.envelopes(rows, "block")
    least = float(np.partition(made[0] @ made.T, -20)[-20])
    every = asked.count() * blocks.count()
    for needed, share in ((-np.inf, 1.0), (0.5 * least, 0.5)):
        pairs = topk.block_pairs(asked.withColumn("least", F.lit(needed)), blocks).collect()
        assert len(pairs) == every if share == 1 else len(pairs) <= share * every
    # No pair of blocks that holds such a score is left out.
    place = {r.vec_id: r.block for r in rows.select("vec_id", "block").collect()}
    row, column = np.nonzero(made @ made.T >= 0.5 * least)
    kept = {(p.query_block, p.block) for p in pairs}
    assert {(place[i], place[j]) for i, j in zip(row.tolist(), column.tolist())} <= kept
    rows.unpersist()


def test_urls(spark):
    pages = [(1, "http://A.Example.NET/en/x?q"), (2, "https://example.com/de/1"), (3, None), (4, ""),
             (5, "x.net/"), (6, "http://b.org/fr/#"), (7, "http://net"), (8, "ftp://x.net//"),
             (9, "http://example.net/eng"), (9, "http://example.net/eng"), (None, "http://org/fr/")]
    frame = spark.createDataFrame(pages, "page_id bigint, url string")
    rules = urls.rule_table(spark, urls.RULES)
    got = urls.judge(frame, rules, rows_per_task=1).collect()
    assert sorted((r.page_id or 0, r.rule, r.verdict) for r in got) == [
        (0, "org/fr/", "allow"), (1, "example.net/en/", "allow"), (2, "example.com/de/", "block"),
        (3, None, "allow"), (4, None, "allow"), (5, None, "allow"), (6, "org/fr/", "allow"),
        (7, None, "allow"), (8, "net/", "block"), (9, "net/", "block"), (9, "net/", "block")]
    assert {r.verdict for r in urls.judge(frame, rules.limit(0)).collect()} == {"allow"}


def test_pipeline_stages(spark, corpus):
    docs = spark.createDataFrame([*corpus, (900, "mail a.b@c.org or 1", "en", "s1", 0)], SCHEMA)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        docs = corpus_pipeline.land(docs, "test")
        kept[name] = docs.collect()
    assert not {0, 1, 2} & {r.doc_id for r in kept["language"]}
    ids = [r.doc_id for r in kept["near_duplicates"]]
    assert len(ids) == len(set(ids)) < len(kept["language"])
    assert not any("a.b@c.org" in r.text for r in kept["personal_data"])
    assert max(sum(r.doc_id == i for r in kept["mixing"]) for i in ids) <= 3
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert last.count() == len(kept["mixing"])

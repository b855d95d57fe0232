"""Hard negatives, token alignment and packing against plain Python and the libraries."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from remitwise.llm import align, negatives, packing
from remitwise.llm.queries import tokenizer

ODD = [None, "", " ", "\n", "  a  b ", "▁▁a ▁", "don't 'S 're ''ve \t x", "日本語 é😀", "a" * 3000,
       "x<|endoftext|>y", "<|ENDOFTEXT|> <|startoftext|>a", "1234 5", "\x00\x1c\x85 　z", "é é  É ΑΣ ας 'S",
       "İstanbul ǅ ﬁ", "a \n\n b;\r\n c", "I'll they've 'tis"]


def texts(count, seed=3):
    draw = random.Random(seed)
    alphabet = [*"abcdehilnorstXYZ  \n\t12é日😀.,'()\r;", "the ", " The", "ing", "tion", "▁", "'ll", "'s",
                "<|", " ", "　", "’", "  "]
    return ODD + ["".join(draw.choices(alphabet, k=draw.randint(0, 80))) for _ in range(count)]


def docs(spark, values):
    """With repeated and null ids and a clashing name."""
    return spark.createDataFrame([(None if i % 50 == 7 else i // 2, t, i) for i, t in enumerate(values)],
                                 "doc_id bigint, text string, DOC_ID2 bigint").withColumnRenamed(
        "DOC_ID2", "Text2").selectExpr("*", "1 as TEXT")


# -- hard negatives -----------------------------------------------------------------------------


def brute(rows, low=80, high=100, k=5):
    held = {}
    for vec_id, v, label in rows:
        if None in (vec_id, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        if vec_id not in held or (label, v) < held[vec_id]:
            held[vec_id] = (label, v)
    whole = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in held.items()}
    out = set()
    for a, (label, v) in whole.items():
        if a % 100:
            continue
        scored = sorted((-sum(map(int.__mul__, v, w)), i, other) for i, (other, w) in whole.items()
                        if i != a and len(w) == len(v))
        for p, positive, _ in [s for s in scored if s[2] == label][:k]:
            fits = [s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p][:k]
            out |= {(a, positive, r + 1, i, -p, -s) for r, (s, i, _) in enumerate(fits)}
    return out


def clustered(n, size=16, spread=0.15, seed=1):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((8, size))
    v = centres[draw.integers(0, 8, n)] + spread * draw.standard_normal((n, size))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").selectExpr(
        "*", "1 as LABEL2", "'x' as Vec_id2")


@pytest.mark.parametrize("spread, blocks", [(0.15, (64, 256)), (2.0, (2, 40))])
def test_hard_negatives_by_brute_force(spark, spread, blocks):
    draw = random.Random(5)
    v = clustered(1500, spread=spread).tolist()
    rows = [(i, x, draw.randrange(10)) for i, x in enumerate(v)]
    rows += [(2000 + i, v[i % 3], i % 10) for i in range(60)]  # ties
    rows += [(100, v[5], 3), (100, v[6], 2), (200, v[200], rows[200][2])]  # repeated ids
    rows += [(None, v[0], 1), (300, None, 1), (3000, v[1], None), (3100, [float("nan")] * 16, 1),
             (3200, [None] * 16, 1), (3300, [float("inf")] + v[0][1:], 1)]
    rows += [(3400 + i, [0.5 * i, -1.0, 2.0], i % 2) for i in range(9)]  # another size
    rows += [(4000, [], 1), (4001, [], 1), (4002, [], 2), (4100, [0.0] * 16, 4)]
    rows += [(-100, [-x for x in v[0]], 4)]
    got = negatives.hard_negatives(
        vectors(spark, rows), "vec_id % 100 = 0", label="if(vec_id % 7 = 0, (label + 1) % 10, label)",
        anchor_block=blocks[0], candidate_block=blocks[1])
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_hard_negatives_of_an_empty_table(spark):
    assert negatives.hard_negatives(vectors(spark, []), "vec_id % 100 = 0").count() == 0


def test_huge_components_are_exact(spark):
    rows = [(100 * i, [1.7e6 * (i + 1), 1e5, 2.0], i % 2) for i in range(6)]
    got = negatives.hard_negatives(vectors(spark, rows), "vec_id % 100 = 0",
                                   label="if(vec_id % 7 = 0, (label + 1) % 10, label)")
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert {tuple(r) for r in got.collect()} == brute(rows)


def block_of(v, labels):
    norm = np.linalg.norm(v, axis=1)
    cos = np.clip(v / norm[:, None] @ negatives.directions(v.shape[1]), -1, 1)
    return negatives.Block(pa.table({
        "vec_id": np.arange(len(v)), "label": labels, "size": np.full(len(v), v.shape[1]), "norm": norm,
        "v": pa.array(v.tolist()), "angles": pa.array(np.arccos(cos).astype(np.float32).tolist())}))


def test_bounds_hold_and_prune():
    """Every score is within its bounds, and few pairs of clustered vectors are scored."""
    v = np.floor(256 * clustered(2000, size=64).astype(np.float64))
    block = block_of(v, np.arange(2000) % 10)
    lo, hi = negatives.bounds(block, block)
    exact = v @ v.T
    assert (lo <= exact).all() and (exact <= hi).all()
    least = np.partition(exact, -6, axis=1)[:, -6].astype(np.int64)
    may = ~np.eye(2000, dtype=bool)
    row, column, score, scored = negatives.windowed(block, block, may, (least * 8) // 10, least, 5)
    assert scored < 0.1 * 2000 * 2000
    assert np.array_equal(score, exact[row, column])


def test_far_blocks_are_not_paired(spark):
    v = clustered(3000, size=64, spread=0.05).tolist()
    rows = negatives.angled(negatives.vectors(vectors(
        spark, [(i, x, i % 10) for i, x in enumerate(v)]), 256, "label"))
    blocks = negatives.blocked(rows, 300, "block")
    ranges = negatives.envelopes(blocks, "block")
    asked = ranges.withColumnRenamed("block", "ablock").selectExpr(
        "*", "cast(50000 as double) as least", "double('infinity') as most")
    n = ranges.count()
    assert n > 5
    assert negatives.block_pairs(asked, ranges).count() < 0.6 * n * n


# -- alignment ------------------------------------------------------------------------------------


def test_ids_equal_the_libraries():
    a, b = align.Bytes(tokenizer("byte_bpe_50k.json")), align.Pieces(tokenizer("piece_bpe_32k.model"))
    from sentencepiece import SentencePieceProcessor

    from remitwise.llm.memo import file_tokenizer

    theirs = file_tokenizer(tokenizer("byte_bpe_50k.json"), plain=True)
    model = SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    values = texts(2500)
    data, offsets = align.spaced(pa.array(values, pa.string()))
    ids_a, ends_a, fine_a = a.ids(data, offsets)
    ids_b, ends_b, fine_b = b.ids(data, offsets)
    assert fine_a.all()
    for i, text in enumerate(t or "" for t in values):
        assert ids_a[ends_a[i]:ends_a[i + 1]].tolist() == theirs.encode(
            " " + text, add_special_tokens=False).ids
        assert fine_b[i] == ("▁" not in text)
        if text and fine_b[i]:
            assert ids_b[ends_b[i]:ends_b[i + 1]].tolist() == model.encode(text)


def aligned_by_hand(values):
    """(counts, digest) of each text and all links, by one pointer pair at a time."""
    from sentencepiece import SentencePieceProcessor

    from remitwise.llm.memo import file_tokenizer

    a = file_tokenizer(tokenizer("byte_bpe_50k.json"), plain=True)
    b = SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in shown}
    byte.update({chr(256 + i): x for i, x in enumerate(sorted(set(range(256)) - set(shown)))})
    out, counted = [], Counter()
    for text in values:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        said_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        said_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                  else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or not b"".join(said_a) == b"".join(said_b) == (" " + text).encode():
            out.append(((0, 0, 0), "", []))
            continue
        links, groups, i, j = [], [], 0, 0
        end_a, end_b = np.cumsum([len(x) for x in said_a]), np.cumsum([len(x) for x in said_b])
        group = ([], [])
        while i < len(ids_a):
            links.append((ids_a[i], ids_b[j]))
            step_a, step_b = end_a[i] <= end_b[j], end_b[j] <= end_a[i]
            if step_a:
                group[0].append(ids_a[i])
            if step_b:
                group[1].append(ids_b[j])
            if step_a and step_b:
                groups.append("|".join(",".join(map(str, g)) for g in group))
                group = ([], [])
            i, j = i + step_a, j + step_b
        counted.update(links)
        out.append(((len(ids_a), len(ids_b), len(groups)),
                    hashlib.sha256(";".join(groups).encode()).hexdigest(), links))
    best = defaultdict(int)
    for (_, y), n in counted.items():
        best[y] = max(best[y], n)
    return [(*n, len(links), sum(counted[p] == best[p[1]] for p in links),
             sum(counted[p] for p in links), digest) for n, digest, links in out]


@pytest.mark.parametrize("lane, part", [(256, 16 << 20), (3, 500)])
def test_alignment_by_hand(spark, monkeypatch, lane, part):
    """Also in many lanes and parts; executors have their own copies, so the tasks' sizes are tested
    through the function that they call."""
    monkeypatch.setattr(align, "LANE", lane)
    values = texts(400) + ["long " * 4000 + "Wörter, и ещё 3000."]
    frame = docs(spark, values)
    got = align.aligned(frame, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"),
                        ("if(n_a = 0, '', sha2(groups, 256)) as groups_sha256",)).collect()
    want = aligned_by_hand(values)
    assert Counter(tuple(r)[1:] for r in got) == Counter(want)
    by_id = {r.doc_id: tuple(r)[1:] for r in got}
    assert by_id[200] in (want[400], want[401])
    a, b = (align.side(k, tokenizer(p)) for k, p in ((align.Bytes, "byte_bpe_50k.json"),
                                                     (align.Pieces, "piece_bpe_32k.model")))
    one = align.align(pa.array(values, pa.string()), a, b)
    assert [tuple(int(one[c][i]) for c in align.COUNTS) for i in range(len(values))] == [
        w[:4] for w in want]
    near, far = align.gaps(one["text"], np.unique(one["pair"], return_inverse=True)[1], len(values))
    numbers, ends = align.numbers(near, far)
    assert np.diff(ends).tolist() == [w[3] for w in want]
    assert sorted(numbers) == sorted(np.unique(one["pair"], return_inverse=True)[1])


def test_alignment_of_an_empty_table(spark):
    assert align.aligned(docs(spark, ["a"]).limit(0), tokenizer("byte_bpe_50k.json"),
                         tokenizer("piece_bpe_32k.model")).count() == 0


# -- packing --------------------------------------------------------------------------------------


def test_packing_by_the_library(spark):
    """Every piece is there with its ids, sequences have no gap and no overflow."""
    from remitwise.llm.memo import file_tokenizer

    path, limit = tokenizer("word_bpe_49k.json"), 64
    theirs = file_tokenizer(path, plain=False)
    values = texts(1500) + ["many words " * 500]
    frame = docs(spark, values).repartition(5)
    got = packing.packed(frame, path, limit).collect()
    want = Counter()
    for r in frame.collect():
        ids = theirs.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), limit):
            part = ids[k:k + limit]
            want[r.doc_id, k // limit, k, len(part), zlib.crc32(np.array(part, "<u4"))] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        held.sort()
        assert [a for a, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))]
        assert sum(n for _, n in held) <= limit
    assert len(sequences) <= best_fit([r.length for r in got], limit)
    assert packing.packed(frame.limit(0), path, limit).count() == 0


def best_fit(lengths, limit):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(limit - n)
    return len(rooms)


@pytest.mark.parametrize("name, draw", [
    ("small", lambda r: r.randint(1, 40)), ("large", lambda r: r.randint(30, 70)),
    ("thirds", lambda r: r.choice([34, 33, 35, 50, 51])), ("one", lambda r: 37),
    ("wide", lambda r: min(100, 1 + int(r.expovariate(0.05))))])
def test_plans_are_whole_and_as_good_as_best_fit(name, draw):
    r = random.Random(name)
    lengths = [draw(r) for _ in range(1200)]
    entries, count = packing.plan(dict(Counter(lengths)), 100)
    fill = defaultdict(list)
    for length, rank, pieces, first, each, offset in entries.tolist():
        for i in range(pieces):
            fill[first + i // each].append((offset + i % each * length, length, rank + i))
    assert Counter(n for held in fill.values() for _, n, _ in held) == Counter(lengths)
    assert len({(n, k) for held in fill.values() for _, n, k in held}) == len(lengths)
    for held in fill.values():
        held.sort()
        assert all(a + n == b for (a, n, _), (b, _, _) in zip(held, held[1:]))
        assert held[0][0] == 0 and held[-1][0] + held[-1][1] <= 100
    assert len(fill) == count <= best_fit(lengths, 100)


def test_groups_have_equal_cardinality():
    lengths, counts = np.array([9, 8, 7, 5]), np.array([10, 30, 3, 57])
    groups = packing.grouped(lengths, counts, 10)
    assert sum(n for g in groups for _, n in g) == 100
    assert [g[0][0] for g in groups] == sorted({g[0][0] for g in groups}, reverse=True)
    assert all(length <= g[0][0] for g in groups for length, _ in g)

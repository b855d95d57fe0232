"""Text operators against the libraries and against plain Python."""

import hashlib
import random
import re

import pyarrow as pa
import pytest

from remitwise.llm import chat, language, pieces, quality, surrogates, tokens
from remitwise.llm.queries import HOSTILE, tokenizer

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [None, "", " ", "\n", "  a  b ", "▁▁a ▁", "don't 'S 're ''ve \t x", "日本語 é😀", "a" * 3000,
       "ab" * 4000, "x<|endoftext|>y", "<|im_end|>", "1234 5", "\x00\x1c\x85 　z"]


def texts(count=1500):
    draw = random.Random(3)
    alphabet = [*"abcdehilnorst  \n\t12é日😀.,'", "the ", "ing", "tion", "▁", "'ll", "<|", "\\"]
    return ODD + ["".join(draw.choices(alphabet, k=draw.randint(0, 60))) for _ in range(count)]


def docs(spark, values, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, t in enumerate(values)], SCHEMA)


def test_pieces_equal_the_library():
    own = pieces.Vocabulary(tokenizer("piece_bpe_32k.model"))
    values = texts()
    ids = own.encode(pa.array(values)).to_pylist()
    assert ids == own.library.encode([t or "" for t in values])
    assert own.decode(pa.array(ids, pa.list_(pa.int32()))).to_pylist() == own.library.decode(ids)
    draw = random.Random(5)
    anything = [[draw.choice([draw.randrange(32000), draw.randrange(259)])
                 for _ in range(draw.randint(0, 9))] for _ in range(800)]
    assert own.decode(pa.array(anything, pa.list_(pa.int32()))).to_pylist() == [
        own.library.decode(x) for x in anything]


def test_token_counts_equal_the_library():
    from tokenizers import Tokenizer

    own = tokens.Counter(tokenizer("byte_bpe_50k.json"))
    theirs = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    values = texts()
    expected = [len(theirs.encode(t or "", add_special_tokens=False).ids) for t in values]
    assert own.counts(pa.array(values)).tolist() == expected


def test_text_operators_in_spark(spark):
    """Repeated rows, clashing names and empty tables."""
    rows = docs(spark, [*ODD, "a"]).selectExpr("*", "1 as DOC_ID", "2 as Text")
    for query in (lambda d: pieces.digests(d, tokenizer("piece_bpe_32k.model")),
                  lambda d: tokens.token_counts(d, tokenizer("byte_bpe_50k.json")),
                  quality.judge, lambda d: surrogates.pseudonymised(d, b"k"), language.identify):
        assert query(rows.union(rows)).count() == 2 * (len(ODD) + 1)
        assert query(docs(spark, [])).count() == 0
    coded = pieces.digests(rows, tokenizer("piece_bpe_32k.model")).collect()
    assert {r.decoded_sha256 for r in coded} == {
        hashlib.sha256((t or "").replace("▁", " ").encode()).hexdigest() for t in [*ODD, "a"]}


def test_chats_read_back(spark):
    turns = [*HOSTILE, (1, 2, "user", None), (1, 1, "assistant", "a<\\|b<|"), (1, 1, "user", "x\n"),
             (2, None, None, "q"), (None, 0, "assistant", "n"), (1, 1, "user", "x\n"),
             (3, 0, "a\\n\nb", "<|im_start|>")]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    formatted = chat.format_chats(frame)
    for row in formatted.collect():
        bare = re.sub(r"<\|im_start\|>[^\n]*\n(?:(?!<\|).)*<\|im_end\|>\n", "", row.formatted,
                      flags=re.DOTALL)
        assert bare == ""
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    order = sorted(turns, key=lambda t: tuple((v is not None, v) for v in t))
    for conv, row in got.items():
        own = [(t[2] or "", t[3] or "") for t in order if t[0] == conv]
        said = "".join(f"{r}\n{t}\n" for r, t in own)
        learned = "".join(t for r, t in own if r == "assistant")
        assert row.n_turns == len(own)
        assert row.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (
            len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert len(got) == 5


def test_languages_are_told_apart(spark):
    words = {"en": "the of and to in is that it was for on are as with",
             "de": "der die und das nicht ist ein zu mit auf für von dem"}
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choices(words[lang].split(), k=30)), lang, "s", 0)
            for i, lang in enumerate(["en", "de"] * 60)]
    rows += [(500, "123 !", "en", "s", 0), (501, None, "de", "s", 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in language.identify(frame).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang, _, _ in rows[:120])
    assert [(got[i].lang_pred, got[i].score) for i in (500, 501)] == [("und", 0.0)] * 2


@pytest.mark.parametrize("text, gone", [
    ("Mail A.b@Mail5.Example.com now", ["A.b@", "Mail5"]), ("+1 (743) 555-3824%%%", ["743", "3824"]),
    ('TOKEN = "9233A8ECF7C5B09F"!!', ["9233A8ECF7C5B09F"]), ("at 10.1.2.3.", ["10.1.2.3"]),
    ("4845168114407329 48451681144073294845168114407329", ["4845168114407329"]),
    ("Mrs. Anna Keller", ["Anna"])])
def test_personal_data_goes(text, gone):
    got, count = surrogates.replaced(text, lambda e: surrogates.surrogate(b"k", *e, 0))
    assert count and not any(g in got for g in gone)
    assert re.sub(r"\w", "", got).replace(".", "") == re.sub(r"\w", "", text).replace(".", "")


def test_no_personal_data_no_change():
    plain = "Version 2.0. 2123465659789240 of 2026-01-02, 12.5 and a@b; Mr x"
    assert surrogates.replaced(plain, lambda e: "?") == (plain, 0)


def test_surrogates_stay_distinct(spark):
    """A few names for many people: collisions must be drawn anew."""
    names = [f"Mr. X{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    got = surrogates.pseudonymised(docs(spark, names + names), b"k").collect()
    said = {r.doc_id: r.text for r in got}
    assert len(set(said.values())) == len(names)
    assert all(said[i] == said[i + len(names)] for i in range(len(names)))

"""Surrogates: nothing found stays, nothing collides, and mentions agree."""

import re

import pytest

from remitwise.llm import surrogates

SCHEMA = "doc_id bigint, text string"
KEY = b"k"


def lookup(entity):
    return surrogates.surrogate(KEY, *entity, 0)


@pytest.mark.parametrize("text, names, kept", [
    ("Mr. Smith met Mr. Smith again", ["smith"], "met"),
    ("Mr. Smith and Mrs. Keller came", ["smith", "keller"], "and came"),
    ("Mr. John Smith Mr. Smith", ["john", "smith"], "Mr."),
    ("Mr. Juan Carlos Garcia Lopez Mendoza Ruiz left", ["juan", "carlos", "garcia", "lopez",
                                                        "mendoza", "ruiz"], "left"),
    ("Mr. John Smith came. Mr. John spoke, Smith left", ["john", "smith"], "came spoke left"),
    ("Mr. Mrs. Keller", ["keller"], "Mr. Mrs."),
    ("госпожа Анна Иванова и Mr. Παπαδόπουλος", ["анна", "иванова", "παπαδόπουλος"], "и"),
    ("Dr.Mr. SMITH smith", ["smith"], "smith"),
])
def test_names_do_not_stay(text, names, kept):
    found = surrogates.find(text)
    assert {n for (_, n), _, _ in found} == {n.casefold() for n in names}
    got, count = surrogates.replaced(text, lookup)
    assert count == len(found)
    for (_, normal), a, b in found:
        assert text[a:b] not in got
    for word in kept.split():
        assert word in got.split() or word in got
    # One entity, one surrogate, whatever its spelling.
    said = {}
    for entity, a, b in found:
        said.setdefault(entity, set()).add(surrogates.spelled(entity, lookup(entity), text[a:b]).casefold())
    assert all(len(s) == 1 for s in said.values())
    assert len(set.union(*said.values())) == len(said)


def test_given_name_alone_is_the_same_person():
    text = "Mr. John Smith came. Mr. John spoke"
    johns = {e for e, a, b in surrogates.find(text) if text[a:b] == "John"}
    assert johns == {("name-latin-m", "john")}


def test_scripts_stay():
    for name, kind in (("Иванов", "cyrillic"), ("Παππάς", "greek"), ("Smith", "latin")):
        entity = surrogates.find(f"Mr. {name} x")[0][0]
        assert entity[0] == f"name-{kind}-"
        assert surrogates._script(lookup(entity)) == kind


def test_long_mail_names():
    text = "x " + "a" * 300 + "@mail.example.org y"
    got, count = surrogates.replaced(text, lookup)
    assert count == 1 and "aaaa" not in got and got.startswith("x ") and got.endswith(" y")


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_permutations(size):
    assert sorted(surrogates.permuted(KEY, ("t",), i, size) for i in range(size)) == list(range(size))


@pytest.mark.parametrize("kind, normals", [
    ("phone", [f"+49-49{n:05d}" for n in range(10000, 14000)]),
    ("phone", [f"0{n:04d}" for n in range(3000)]),
    ("ssn", [f"{n:09d}" for n in range(4000)]),
    ("ip", [f"10.0.{n >> 8}.{n & 255}" for n in range(4000)] + ["0.1.2.3", "255.0.0.1"]),
    ("email", [f"u{n}@{h}" for n in range(2000) for h in ("a.com", "a.org")]),
    ("secret", [f"Ab{n:06d}" for n in range(3000)] + [f"ab{n:06d}" for n in range(3000)]),
    ("name-latin-", [f"name{n}" for n in range(2000)]),
])
def test_one_surrogate_each_in_the_same_format(kind, normals):
    own = [surrogates.surrogate(KEY, kind, n, 0) for n in normals]
    assert len(set(own)) == len(normals)
    if not kind.startswith("name") and kind not in ("ip", "email"):
        shape = [re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"\d", "0", x))) for x in own]
        want = [re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"\d", "0", x))) for x in normals]
        assert shape == want


def cards(n):
    out = []
    for i in range(n):
        body = f"4{i * 7919:014d}0"
        out.append(body[:-1] + str(surrogates.luhn(body)))
    return out


def test_cards_stay_cards():
    own = [surrogates.surrogate(KEY, "card", c, 0) for c in cards(500)]
    assert len(set(own)) == 500 and all(map(surrogates.is_card, own))
    assert {c[0] for c in own} == {"4"} and {len(c) for c in own} == {16}


def people(n):
    syllables = ["Ba", "Ke", "Li", "Mo", "Ru", "Sa", "Te", "Vo", "Za", "Ni"]
    return ["".join(syllables[i // 10**k % 10] if k == 0 else syllables[i // 10**k % 10].lower()
                    for k in range(4)) for i in range(n)]


@pytest.mark.parametrize("small", [True, False])
def test_distinct_and_coherent_over_a_table(spark, monkeypatch, small):
    """A thousand names, each in two documents; also where redrawn entities are joined to texts."""
    if not small:
        monkeypatch.setattr(surrogates, "is_small", lambda df: False)
        # Every first draw of a name collides, so all names draw anew.
        monkeypatch.setattr(surrogates, "drawn", crowded(surrogates.drawn))
    names = people(1000)
    rows = [(i % 7, f"Mr. {n} wrote to x{i}@mail.org, {n} said") for i, n in enumerate(names)]
    rows += [(None, f"Mrs. Anna {n}") for n in names] + [(1, None), (1, ""), (1, "plain")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], SCHEMA + ", Text2 int")
    got = surrogates.pseudonymised(df, KEY).collect()
    assert len(got) == len(rows)
    said = [r.text for r in got if r.text]
    by_mail = [re.fullmatch(r"Mr\. (\w+) wrote to (\S+), (\w+) said", t) for t in said]
    found = [m for m in by_mail if m]
    assert len(found) == 1000 and all(m[1] == m[3] for m in found)
    assert len({m[1] for m in found}) == 1000 and len({m[2] for m in found}) == 1000
    partner = {re.fullmatch(r"Mrs\. (\w+) (\w+)", t)[2] for t in said if t.startswith("Mrs.")}
    assert partner == {m[1] for m in found}
    assert not {m[1] for m in found} & set(names)
    assert len({t.split()[1] for t in said if t.startswith("Mrs.")}) == 1
    assert "plain" in said and sum(r.text is None for r in got) == 1
    assert surrogates.pseudonymised(df.limit(0), KEY).count() == 0


def crowded(drawn):
    def some(entities, key):
        return drawn(entities, key).selectExpr(
            "kind", "normal", "attempt",
            "if(attempt = 0 and kind like 'name%', 'same', own) as own")
    return some

"""Operator 7: personal data is replaced by keyed surrogates.

Found are mail addresses, IPv4 addresses, payment cards (issuer prefix and Luhn digit), phone numbers,
social security numbers, quoted secrets after a name such as `token =`, and names: the capitalised
words after an honorific, up to the next honorific, and the same words elsewhere in the same text. Of
several such words the last is the surname; one alone is a surname, unless the text has it as a given
name. An entity is its kind and its normal form. Its surrogate comes from a key and these only, so the
same entity has the same surrogate in every document, whatever its spelling there, and nobody without
the key can go back. A surrogate keeps kind and format: separators, number of digits, letter case, the
first digit and a right check digit of a card, the country code of a phone; a name keeps its script and
gender, and given names and surnames are entities of their own, so that partial mentions agree. Mail
hosts end in a reserved domain.

Numbers, addresses and secrets go through a keyed permutation of their format (a Feistel network that is
walked until it is back in the format), so two of one format never share a surrogate; names are composed
of syllables, with a hundred million names per script and gender. The collision checks run over the
entities of all documents: two entities of a kind with one surrogate, or a surrogate that is an entity
of the documents. All but the first of such entities draw anew until there is none. Texts are never
joined to entities: the few that drew anew are given to every task as long as they are BROADCAST_ROWS at
most, and beyond that only the texts that mention one meet them; all other surrogates are drawn where
they stand.

Null text stays null; texts without an entity stay as they are. Texts of any length are searched whole.
Repeated rows, and null or repeated ids, do no harm: nothing is grouped by them. Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitwise.llm.common import land, map_batches, pick, steps
from remitwise.operators.bloom import may_match, may_not_match, words_for
from remitwise.operators.skew import is_small, spread_join

# Honorifics and the gender that they tell.
HONORIFICS = {
    "m": ["Mr.", "Mr", "Mister", "Herr", "Monsieur", "Señor", "Signor", "господин"],
    "f": ["Mrs.", "Mrs", "Ms.", "Ms", "Miss", "Frau", "Madame", "Mademoiselle", "Señora",
          "Señorita", "Signora", "госпожа"],
}
# What names are composed of, by script: the consonants and vowels of syllables, and endings by gender
# ("" for surnames). Four syllables give a hundred million names.
SYLLABLES = {
    "latin": ("bdfghjklmnprstvzwcyx", "aeiou", {"m": ["n", "r", "s"], "f": ["na", "la", "ra"],
                                                "": ["ner", "man", "sen"]}),
    "cyrillic": ("бвгджзклмнпрстфхцчшщ", "аеиоу", {"m": ["н", "р", "й"], "f": ["на", "ла", "ра"],
                                                   "": ["нко", "рук", "сян"]}),
    "greek": ("βγδζθκλμνξπρστφχψ", "αεηιου", {"m": ["ν", "ς", "ρ"], "f": ["να", "λα", "ρα"],
                                               "": ["νης", "κος", "λας"]}),
}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLES = "|".join(re.escape(t) for g in HONORIFICS.values() for t in sorted(g, key=len, reverse=True))
_NAME = r"[^\W\d_][^\W\d_]+(?:[-'’][^\W\d_]+)*"
PATTERN = re.compile(
    r"(?P<email>(?<![\w.+-])[\w+-](?:[\w.+-]*[\w+-])?@[\w-]+(?:\.[\w-]+)+)"
    r"|(?<!\w)(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key|auth[_-]?key)[\"']?"
    r"[ \t]*[:=][ \t]*[\"'](?P<secret>[^\"'\s]{8,})[\"']"
    rf"|(?<![\w.])(?P<ip>{_OCTET}(?:\.{_OCTET}){{3}})(?![\w]|\.\d)"
    r"|(?<![\w.+-])(?P<card>\d{13,}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{4}"
    r"|\d{4}(?P<gap2>[ -])\d{6}(?P=gap2)\d{5})(?![\w]|[.-]\d)"
    r"|(?<![\w.-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w]|[.-]\d)"
    # Bare groups with blanks between them may go on after a blank; other numbers end there.
    r"|(?<![\w.+-])(?P<phone>(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])|\(\d{2,4}\)[ .-]?)"
    r"\d{3,4}[ .-]\d{3,4}|\+[1-9]\d{7,14}|\+\d{1,3}[ .-]\d(?:[ .-]\d{2}){4}"
    r"|\+\d{1,3}[ .-]\d{2,5}[ .-]\d{5,8}|\d{2,4}[ .-]\d{3,4}(?:[.-]\d{3,4}| \d{3,4}(?! \d)))(?![\w]|[.-]\d)"
    rf"|(?<!\w)(?P<title>{_TITLES})[ \t]+(?P<person>{_NAME})")
_MORE = re.compile(rf"[ \t]+({_NAME})")
_WORD = re.compile(_NAME)
_PLAIN_TITLES = {t.rstrip(".").casefold() for g in HONORIFICS.values() for t in g}
# What a text needs for any entity: cheap, run by Arrow over whole columns.
HINT = rf"\d|@|[:=][ \t]*[\"']|(?:{_TITLES})[ \t]"

# Country codes of one and two digits; all others have three.
_CODES = re.compile(r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")

Entity = tuple[str, str]


def luhn(digits: str) -> int:
    """The digit that `digits` without its last one asks for."""
    total = 0
    for i, d in enumerate(reversed(digits[:-1])):
        d = int(d) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def is_card(digits: str) -> bool:
    """Issuer prefixes of the large networks, and the check digit."""
    issued = (digits[0] == "4" or "51" <= digits[:2] <= "55" or "2221" <= digits[:4] <= "2720"
              or digits[:2] in ("34", "37", "65", "36", "38") or digits[:4] == "6011")
    return issued and luhn(digits) == int(digits[-1])


def _script(name: str) -> str:
    if any("Ѐ" <= c <= "ӿ" for c in name):
        return "cyrillic"
    return "greek" if any("Ͱ" <= c <= "Ͽ" for c in name) else "latin"


def _is_name(word: str) -> bool:
    return word[0].isupper() and word.casefold() not in _PLAIN_TITLES


def _words(text: str, match: re.Match) -> list[tuple[int, int]]:
    """Where the words of a mention are: the capitalised ones behind an honorific."""
    if not _is_name(match["person"]):
        return []
    out = [match.span("person")]
    while (more := _MORE.match(text, out[-1][1])) and _is_name(more[1]):
        out.append(more.span(1))
    return out


Found = tuple[Entity, int, int]


def _names(text: str, persons: list[tuple[str, list[tuple[int, int]]]], taken: list[Found]) -> list[Found]:
    """Given names and surnames of the mentions, and the same words elsewhere."""
    out, known = [], {}

    def named(a: int, b: int, gender: str) -> Entity:
        return f"name-{_script(text[a:b])}-{gender}", text[a:b].casefold()

    alone = []
    for gender, words in persons:
        if len(words) == 1:
            alone.append((gender, *words[0]))
            continue
        for i, (a, b) in enumerate(words):
            entity = named(a, b, gender if i < len(words) - 1 else "")
            known[entity] = None
            out.append((entity, a, b))
    for gender, a, b in alone:
        entity = named(a, b, gender)
        entity = entity if entity in known else named(a, b, "")
        known[entity] = None
        out.append((entity, a, b))
    # A word that is both goes by the surname.
    elsewhere = {normal: entity for entity in sorted(known, reverse=True) for normal in (entity[1],)}
    begun = sorted((a, b) for _, a, b in (*taken, *out))
    at = 0
    for word in _WORD.finditer(text):
        entity = elsewhere.get(word[0].casefold()) if word[0][0].isupper() else None
        if entity is None:
            continue
        a, b = word.span()
        while at < len(begun) and begun[at][1] <= a:
            at += 1
        if at == len(begun) or begun[at][0] >= b:
            out.append((entity, a, b))
    return out


def find(text: str) -> list[Found]:
    """(entity, begin, end) of all mentions in a text, in their order."""
    out, persons, at = [], [], 0
    while m := PATTERN.search(text, at):
        at = m.end()
        kind = m.lastgroup
        if kind in ("gap", "gap2"):
            kind = "card"
        if kind == "person":
            words = _words(text, m)
            if words:
                persons.append(("m" if m["title"] in HONORIFICS["m"] else "f", words))
            at = words[-1][1] if words else m.end("title")
            continue
        said = m[kind]
        digits = re.sub(r"\D", "", said)
        if kind == "card":
            # Cards that follow each other without a gap.
            cards = [digits] if len(digits) <= 19 else [
                digits[i:i + 16] for i in range(0, len(digits), 16)]
            if all(13 <= len(c) and is_card(c) for c in cards):
                size = len(said) // len(cards)
                out += [((kind, c), m.start(kind) + i * size, m.start(kind) + (i + 1) * size)
                        for i, c in enumerate(cards)]
            continue
        if kind == "email":
            normal = said.lower()
        elif kind == "secret":
            normal = said.lower() if re.fullmatch(r"[0-9a-fA-F]+", said) else said
        else:
            normal = said if kind == "ip" else digits
        if kind == "phone" and said[0] == "+":
            # The country code is told from the number by what follows it, if anything does.
            code = re.match(r"\d+", said[1:])[0]
            normal = "+" + (code if len(code) <= 3 else _CODES.match(code)[0]) + "-" + digits
        out.append(((kind, normal), m.start(kind), m.end(kind)))
    if persons:
        out = sorted(out + _names(text, persons, out), key=lambda f: f[1])
    return out


class Draw:
    """A stream of keyed random numbers for one entity and attempt."""

    def __init__(self, key: bytes, *parts: object):
        self.seed = hashlib.blake2b(repr(parts).encode(), key=key[:64]).digest()
        self.block, self.count = 0, 0

    def below(self, n: int) -> int:
        if not self.count:
            self.block = int.from_bytes(hashlib.blake2b(self.seed).digest(), "big")
            self.seed, self.count = hashlib.blake2b(self.seed + b"next").digest(), 24
        self.block, out = divmod(self.block, 1 << 20)
        self.count -= 1
        return out * n >> 20

    def like(self, text: str, letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
        """Letters for letters, digits for digits; anything else stays."""
        return "".join("0123456789"[self.below(10)] if c.isdigit() else
                       letters[self.below(len(letters))] if c.isalpha() else c for c in text)


def permuted(key: bytes, tweak: tuple, value: int, size: int) -> int:
    """A keyed permutation of the numbers below `size`."""
    if size < 2:
        return value
    half = math.isqrt(size - 1) + 1
    seed = hashlib.blake2b(repr(tweak).encode(), key=key[:64]).digest()
    width = half.bit_length() // 8 + 9
    while True:
        left, right = divmod(value, half)
        for turn in range(8):
            mixed = hashlib.shake_256(seed + b"%d:%d" % (turn, right)).digest(width)
            left, right = right, (left + int.from_bytes(mixed, "big")) % half
        value = left * half + right
        if value < size:  # else walk on: the walk comes back to the format
            return value


_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def reformed(key: bytes, tweak: tuple, text: str, hexadecimal: bool = False) -> str:
    """Digits for digits and letters for letters by a permutation; anything else stays.

    Text with other letters than ASCII ones is drawn, since its format has no fixed alphabet.
    """
    if not text.isascii():
        return Draw(key, *tweak, text).like(text)
    letters = [next((a for a in _ALPHABETS if c in a), c) for c in text]
    if hexadecimal:
        letters = [a[:6] if len(a) == 26 else a for a in letters]
    size, value = 1, 0
    for c, alphabet in zip(text, letters, strict=True):
        size, value = size * len(alphabet), value * len(alphabet) + alphabet.index(c)
    # The other characters are part of the format.
    form = "".join(c if len(a) == 1 else str(len(a)) for c, a in zip(text, letters, strict=True))
    value = permuted(key, (*tweak, form), value, size)
    out = []
    for alphabet in reversed(letters):
        value, i = divmod(value, len(alphabet))
        out.append(alphabet[i])
    return "".join(reversed(out))


def surrogate(key: bytes, kind: str, normal: str, attempt: int) -> str:
    """The normal form of an entity's surrogate.

    Later attempts have more room than the entity's own format, so that drawing anew ends.
    """
    tweak = (kind, attempt)
    more = Draw(key, kind, normal, attempt)
    room = max(0, attempt - 3)
    if kind == "email":
        local, _, host = normal.rpartition("@")
        host = reformed(key, ("host",), host)  # one host stays one host
        return f"{reformed(key, (*tweak, host), local)}{more.like('x' * room)}@{host}.example"
    if kind == "secret":
        plain = re.fullmatch(r"[0-9a-f]+", normal) is not None
        return reformed(key, tweak, normal, plain) + more.like("0" * room)
    if kind == "ip":
        first, *rest = map(int, normal.split("."))
        value = first << 24 | rest[0] << 16 | rest[1] << 8 | rest[2]
        common = 1 <= first <= 223
        while True:
            value = permuted(key, tweak, value, 1 << 32)
            if (1 <= value >> 24 <= 223) == common:
                return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))
    if kind == "card":
        size = len(normal) - 2
        value = int(normal[1:-1])
        while True:
            value = permuted(key, (*tweak, normal[0], size), value, 10**size)
            body = f"{normal[0]}{value:0{size}d}0"
            body = body[:-1] + str(luhn(body))
            if is_card(body):
                return body
    if kind in ("phone", "ssn"):
        code, _, number = normal.rpartition("-")
        keep = max(0, len(code) - 1)
        rest = number[keep:]
        # A number with a leading zero stays one, and any other does not get one.
        begin = 0 if rest[:1] == "0" else 10 ** (len(rest) - 1)
        size = 10 ** (len(rest) - 1) if rest[:1] == "0" else 9 * begin
        value = begin + permuted(key, (*tweak, code, len(rest), begin), int(rest) - begin, size)
        return (code + "-" if code else "") + number[:keep] + f"{value:0{len(rest)}d}"
    _, script, gender = kind.split("-")
    consonants, vowels, endings = SYLLABLES[script]
    count = 4 if gender == "" else 3
    said = "".join(consonants[more.below(len(consonants))] + vowels[more.below(len(vowels))]
                   for _ in range(count + min(attempt, 8)))
    return said + endings[gender][more.below(len(endings[gender]))]


def spelled(entity: Entity, own: str, said: str) -> str:
    """A surrogate in the format of the mention that it replaces."""
    kind = entity[0]
    if kind.startswith("name-"):
        return own.upper() if said.isupper() and len(said) > 1 else own.capitalize()
    if kind in ("card", "phone", "ssn"):
        digits = iter(own.rpartition("-")[2])
        return "".join(next(digits) if c.isdigit() else c for c in said)
    if kind in ("email", "secret") and said.upper() == said and said.lower() != said:
        return own.upper()
    return own


def replaced(text: str, lookup: Callable[[Entity], str]) -> tuple[str, int]:
    """The text with surrogates, and the number of mentions."""
    out, at = [], 0
    found = find(text)
    for entity, a, b in found:
        out += [text[at:a], spelled(entity, lookup(entity), text[a:b])]
        at = b
    return "".join([*out, text[at:]]), len(found)


# Tells texts apart, so that copies of a text are one.
_TEXT = "xxhash64(text)"


def mentions(docs: DataFrame) -> DataFrame:
    """(text_hash, kind, normal): the entities of each text, each once per row."""
    rows = pick(docs, "text").selectExpr(f"{_TEXT} as text_hash", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                hint = pc.fill_null(pc.match_substring_regex(step.column(1), HINT), False)
                step = step.filter(hint)
                place, kinds, normals = [], [], []
                for i, text in enumerate(step.column(1).to_pylist()):
                    for kind, normal in sorted({e for e, _, _ in find(text)}):
                        place.append(i)
                        kinds.append(kind)
                        normals.append(normal)
                yield pa.RecordBatch.from_arrays(
                    [step.column(0).take(pa.array(place, pa.int64())),
                     pa.array(kinds, pa.string()), pa.array(normals, pa.string())],
                    ["text_hash", "kind", "normal"])

    return map_batches(rows, work, "text_hash bigint, kind string, normal string")


def drawn(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, normal, attempt, own) for (kind, normal, attempt)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([surrogate(key, *r) for r in rows], pa.string())],
                ["kind", "normal", "attempt", "own"])

    return map_batches(entities.select("kind", "normal", "attempt"), work,
                       "kind string, normal string, attempt int, own string")


def assigned(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, normal, attempt, own): surrogates that differ from each other and from all entities."""
    table = land(drawn(entities.selectExpr("kind", "normal", "0 as attempt"), key), "drawn")
    while True:
        shared = table.groupBy("kind", "own").agg(
            F.expr("min(struct(attempt, normal)) as first"), F.expr("count(*) as n"))
        judged = spread_join(table, shared, ["kind", "own"], "n", "normal")
        real = entities.selectExpr("kind as real_kind", "normal as real_normal")
        judged = judged.join(real, F.expr("kind = real_kind and own = real_normal"), "left")
        judged = land(judged.selectExpr(
            "kind", "normal", "attempt", "own",
            "real_normal is not null or first.normal <> normal as clash"), "judged")
        clashing = judged.filter("clash")
        if clashing.isEmpty():
            return table
        again = drawn(clashing.selectExpr("kind", "normal", "attempt + 1 as attempt"), key)
        table = land(judged.filter("not clash").drop("clash").unionByName(again), "drawn")


def pseudonymised(docs: DataFrame, key: bytes, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, n_entities, columns to carry): every text with its personal data replaced.

    `key` is the secret that surrogates depend on; the same key gives the same surrogates.
    """
    found = land(mentions(docs), "mentions")
    entities = land(found.groupBy("kind", "normal").agg(F.expr("count(*) as docs")), "entities")
    again = assigned(entities, key).filter("attempt > 0").select("kind", "normal", "own")
    rows = pick(docs, "doc_id", "text", *carry)
    none = "cast(null as array<struct<kind: string, normal: string, own: string>>) as again"
    if is_small(again):
        # At most BROADCAST_ROWS entities.
        drawn_anew = {(r.kind, r.normal): r.own for r in again.collect()}
        return _replaced(rows.selectExpr("*", none), key, drawn_anew, carry)
    # Only texts that mention such an entity meet them: one list per text, no longer than its mentions.
    facts = again.join(entities, ["kind", "normal"])
    said = spread_join(may_match(found, again, ["kind", "normal"]), facts, ["kind", "normal"], "docs",
                       "text_hash")
    lists = land(said.groupBy("text_hash").agg(
        F.expr("collect_set(struct(kind, normal, own)) as again")), "drawn_anew")
    rows = rows.selectExpr("*", f"{_TEXT} as text_hash")
    words = words_for(lists.count())
    touched = may_match(rows, lists, ["text_hash"], words)
    sized = touched.groupBy("text_hash").agg(F.expr("count(*) as copies")).join(
        lists, "text_hash", "left")
    met = spread_join(touched, sized, ["text_hash"], "copies", "doc_id").drop("copies", "text_hash")
    rest = may_not_match(rows, lists, ["text_hash"], words).drop("text_hash").selectExpr("*", none)
    return _replaced(rest.unionByName(met), key, {}, carry)


def _replaced(rows: DataFrame, key: bytes, drawn_anew: dict[Entity, str], carry: tuple[str, ...]
              ) -> DataFrame:
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema
                      if f.name != "again")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                column = step.column(1)
                hint = pc.fill_null(pc.match_substring_regex(column, HINT), False)
                place = pc.indices_nonzero(hint).to_pylist()
                texts, counts = [], [0] * step.num_rows
                touched = step.filter(hint)
                for i, text, other in zip(place, touched.column(1).to_pylist(),
                                          touched.column("again").to_pylist(), strict=True):
                    own = drawn_anew | {(o["kind"], o["normal"]): o["own"] for o in other or []} \
                        if other else drawn_anew
                    text, counts[i] = replaced(
                        text, lambda e, own=own: own.get(e) or surrogate(key, *e, 0))
                    texts.append(text)
                column = pc.replace_with_mask(column, hint, pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [step.column(0), column, *(step.column(c) for c in carry),
                     pa.array(counts, pa.int64())], ["doc_id", "text", *carry, "n_entities"])

    return map_batches(rows, work, f"{kinds}, n_entities bigint")

"""Personal data and secrets replaced by surrogates of the same kind.

Found are e-mail and IP addresses, phone and card numbers, keys and tokens, and
names after a form of address or title. Digits without separators are a card number
only if they pass its check digit. A value is brought into one form (its characters
without separators and case; a phone number without its country), and a keyed hash
of that draws the surrogate, so a value has the same surrogate in all documents,
however it is written there. A surrogate has the value's length and kinds of
characters, its script, its separators and capitals; a card number passes or fails
its check digit as before; an octet stays an octet.

A person's names are drawn one by one: a given name ends as names of its gender do,
a surname the same way whoever bears it. A name that was found in a document is
replaced wherever else it stands there as a word, so mentions stay one person. The
hosts of addresses are values of their own and stay distinct too.

Two values may draw the same surrogate, and a surrogate may be a value of the
corpus. All distinct values are checked for both, and the later one (by value)
draws again until neither happens. After ``SAME_LENGTH`` draws each further one is
a character longer (octets of any width, IPv6 in the end), so short values that
crowd their length settle too. What was drawn again is looked up when texts
are replaced; everything else needs no table.

Null and empty texts hold nothing and stay. Repeated rows are replaced alike. An
empty table gives an empty one. The intermediate tables hold values: the shared
folder must be as safe as the documents.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylens.llm.arrays import Texts
from vacancylens.llm.frames import joined_with_text, over_texts, split_off_text, stored

#: Forms of address (fixed values), by the gender of the name that follows.
MALE_FORMS = "Mr Sir Herr Herrn Monsieur Señor Sr Don Signor господин пан κύριος".split()
FEMALE_FORMS = "Mrs Ms Miss Madam Frau Fräulein Madame Mme Mademoiselle Señora Señorita Sra Doña Signora госпожа пані κυρία".split()
#: Titles that tell no gender (fixed values).
NEUTRAL_FORMS = "Dr Prof Professor Doctor Doktor Docteur Rev доктор профессор".split()

#: Bytes of drawn-again values, by documents, that may be broadcast; beyond it Spark shuffles.
BROADCAST_BYTES = 16 << 20
#: Draws of a value's own length; each later one has one character more.
SAME_LENGTH = 4
#: Never reached: surrogates have 36 more characters by then.
MOST_DRAWS = 40
#: Draws of an IP address that may be one of IPv6: the last ones.
LAST_DRAWS = 4

#: Labels of secrets in any case; the first letter stands for itself, so other places are left fast.
_LABELS = "[Tt](?i:oken)|[Ss](?i:ecret)|[Pp](?i:asswor[dt]|asswd|wd)|[Aa](?i:pi[_-]?key|ccess[_-]?key)|[Bb](?i:earer)"
_FORMS = "|".join(sorted(MALE_FORMS + FEMALE_FORMS + NEUTRAL_FORMS, key=len, reverse=True))
_TITLES = "|".join(NEUTRAL_FORMS)
# Every part is bounded or begins where a run begins, so long words cost no more.
_FOUND = re.compile(
    rf"""
      (?:(?:{_LABELS})["']?\s*[=:]\s*["']?(?:[Bb](?i:earer)\s+)?|[Bb](?i:earer)\s+(?=[a-z+/_.~-]*[0-9A-Z]))(?P<labelled>[A-Za-z0-9+/_.~-]{{12,}})
    | (?<![0-9A-Za-z])(?P<hex>[0-9a-f]{{32,}}|[0-9A-F]{{32,}})(?![0-9A-Za-z])
    | (?<![\w.%+-])(?P<email>[\w.%+-]{{1,256}}@\w[\w-]{{0,62}}(?:\.\w[\w-]{{0,62}})+)
    | (?<![\w.])(?P<ip>(?:\d{{1,3}}\.){{3}}\d{{1,3}})(?!\d|\.\d)
    | (?<![\w+])(?P<phone>(?:\+\d{{1,3}}[ .-]?)?(?:\(\d{{2,4}}\)[ .-]?|\d{{3}}[ .-])\d{{3}}[ .-]\d{{4}}|\+\d{{1,3}}(?:[ .-]?\d{{2,4}}){{2,5}})(?!\d)
    | (?<![\d])(?P<card>\d{{4}}[ -]\d{{4}}[ -]\d{{4}}[ -]\d{{1,7}}|\d{{4}}[ -]\d{{6}}[ -]\d{{5}}|\d{{13,19}})(?!\d)
    | \b(?P<form>{_FORMS})\.?\ (?:(?:{_TITLES})\.?\ ){{0,2}}(?P<name>[^\W\d_a-zà-þа-я][^\W\d_]+(?:[ -][^\W\d_a-zà-þа-я][^\W\d_]+){{0,2}})
    """,
    re.VERBOSE,
)
_MAYBE = re.compile("|".join(["[@0-9]", f"(?:{_LABELS})", *MALE_FORMS, *FEMALE_FORMS, *NEUTRAL_FORMS]))

_LETTERS = {"LATIN": "abcdefghijklmnopqrstuvwxyz", "CYRILLIC": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "GREEK": "αβγδεζηθικλμνξοπρστυφχψω"}
_VOWELS = {"LATIN": "aeiou", "CYRILLIC": "аеиоу", "GREEK": "αεηιου"}
_CONSONANTS = {"LATIN": "bcdfghklmnprstvz", "CYRILLIC": "бвгдзклмнпрст", "GREEK": "βγδζκλμνπρστ"}
_LAST = {"LATIN": ("n", "a"), "CYRILLIC": ("н", "а"), "GREEK": ("ς", "α")}


class _Draw:
    """An endless stream of numbers from a key, a kind, a value and an attempt."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.state = hashlib.blake2b(f"{kind}\0{attempt}\0{value}".encode(), key=key, digest_size=32)
        self.pool, self.bits, self.round = 0, 0, 0

    def below(self, n: int) -> int:
        while True:
            if self.bits < 32:
                block = hashlib.blake2b(self.state.digest() + self.round.to_bytes(8), digest_size=64).digest()
                self.pool, self.bits, self.round = int.from_bytes(block), 512, self.round + 1
            got = self.pool & 0xFFFFFFFF
            self.pool >>= 32
            self.bits -= 32
            if got < (1 << 32) // n * n:
                return got % n

    def of(self, choices: str) -> str:
        return choices[self.below(len(choices))]


def _script(text: str) -> str:
    for c in text:
        if c.isalpha():
            first = unicodedata.name(c, "LATIN").split()[0]
            return first if first in _VOWELS else "LATIN"
    return "LATIN"


def _luhn(digits: str) -> int:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10


def _same_kinds(value: str, draw: _Draw) -> str:
    """Digits for digits and letters of the script for letters; the rest stays."""
    letters = _LETTERS[_script(value)]
    return "".join(draw.of("0123456789") if c.isdigit() else draw.of(letters) if c.isalpha() else c for c in value)


def _octet(width: int, draw: _Draw) -> str:
    low, high = ((0, 9), (10, 99), (100, 255))[width - 1]
    return str(low + draw.below(high - low + 1))


def _ip(value: str, draw: _Draw, more: int) -> str:
    """Octets as wide as the value's, then of any width; in the end an address of IPv6."""
    if not more:
        return ".".join(_octet(len(o), draw) for o in value.split("."))
    if more <= MOST_DRAWS - SAME_LENGTH - LAST_DRAWS:
        return ".".join(str(draw.below(256)) for _ in range(4))
    return "2001:db8:" + ":".join(f"{draw.below(1 << 16):04x}" for _ in range(6))


def _domain(domain: str, key: bytes, attempt: int) -> str:
    """A host by itself; its last part stays, and ``example`` before it."""
    draw = _Draw(key, "domain", domain, attempt)
    labels = domain.split(".")
    kept = 2 if len(labels) > 2 and labels[-2] == "example" else 1
    moved = [_same_kinds(x, draw) for x in labels[:-kept]]
    moved[-1] += "".join(draw.of(_LETTERS[_script(moved[-1])]) for _ in range(max(0, attempt - SAME_LENGTH + 1)))
    return ".".join(moved + labels[-kept:])


def _email(value: str, draw: _Draw, key: bytes, more: int, host: int) -> str:
    """Local part by the whole address; the domain by itself, so hosts stay one."""
    local, _, domain = value.partition("@")
    longer = "".join(draw.of(_LETTERS[_script(local)]) for _ in range(more))
    return f"{_same_kinds(local, draw)}{longer}@{_domain(domain, key, host)}"


def _spoken(part: str, draw: _Draw, more: int, last: str) -> str:
    """A word of a name's length (and ``more``) that can be spoken and ends as said."""
    if len(part) < 2:
        return part
    script, start = _script(part), draw.below(2)
    letters = [draw.of((_VOWELS if (k + start) % 2 else _CONSONANTS)[script]) for k in range(len(part) - 1 + more)]
    return "".join(letters) + last


def _name(value: str, draw: _Draw, more: int) -> str:
    """A given name by its gender; of unknown gender it ends like the name itself."""
    gender, value = value[0], value[2:]
    parts = re.split(r"([ -])", value)
    out = []
    for at, part in enumerate(parts):
        last = _LAST[_script(value)]
        female = gender == "f" or gender == "n" and part.endswith(last[1])
        out.append(_spoken(part, draw, more if at == len(parts) - 1 else 0, last[female]))
    return f"{gender}:" + "".join(out)


def surrogate(key: bytes, kind: str, value: str, attempt: int, host: int = 0) -> str:
    """What a value in its one form is replaced by, in that form; ``host`` is the attempt of an address's domain."""
    draw = _Draw(key, kind, value, attempt)
    more = max(0, attempt - SAME_LENGTH + 1)
    if kind == "email":
        return _email(value, draw, key, more, host)
    if kind == "domain":
        return _domain(value, key, attempt)
    if kind == "ip":
        return _ip(value, draw, more)
    if kind == "phone":
        country, _, rest = value.rpartition("+")
        return f"{country}+{draw.of('23456789')}" + "".join(draw.of("0123456789") for _ in range(len(rest) - 1 + more))
    if kind == "card":
        body = value[0] + "".join(draw.of("0123456789") for _ in range(len(value) - 2 + more))
        last = [d for d in "0123456789" if (_luhn(body + d) == 0) == (_luhn(value) == 0)]
        return body + last[draw.below(len(last))]
    if kind == "name":
        return _name(value, draw, more)
    if kind == "surname":
        last = _LAST[_script(value)]
        return _spoken(value, draw, more, last[value.endswith(last[1])])
    if re.fullmatch("[0-9a-f]+", value) or re.fullmatch("[0-9A-F]+", value):
        digits = "0123456789abcdef" if value == value.lower() else "0123456789ABCDEF"
        return "".join(draw.of(digits) for _ in range(len(value) + more))
    cased = "".join(
        draw.of("0123456789") if c.isdigit() else draw.of("abcdefghijklmnopqrstuvwxyz") if c.islower()
        else draw.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c.isupper() else c
        for c in value
    )
    return cased + "".join(draw.of("abcdefghijklmnopqrstuvwxyz") for _ in range(more))


def _one_form(kind: str, shown: str) -> str:
    if kind == "email":
        return shown.lower()
    if kind == "card":
        return re.sub(r"\D", "", shown)
    if kind == "phone":
        digits = re.sub(r"\D", "", shown)
        country = re.match(r"\+(\d{1,3})(?=\D)", shown)
        if shown[0] == "+" and digits[0] == "1" and len(digits) == 11:
            return f"+{digits[1:]}"
        return f"+{digits[len(country[1]) :] if country else digits}"
    return shown


def _gender(form: str) -> str:
    return "f" if form in FEMALE_FORMS else "m" if form in MALE_FORMS else "n"


def _names(start: int, shown: str, form: str) -> Iterator[tuple[int, int, str, str]]:
    """The parts of a full name, each by itself: the last word is the surname."""
    words = [(m.start(), m[0]) for m in re.finditer(r"[^ ]+", shown)]
    for at, (lo, word) in enumerate(words):
        for m in re.finditer(r"[^-]+", word):
            kind, value = ("surname", m[0].lower()) if at == len(words) - 1 else ("name", f"{_gender(form)}:{m[0].lower()}")
            yield start + lo + m.start(), start + lo + m.end(), kind, value


def _mentions(text: str, found: list[tuple[int, int, str, str]]) -> Iterator[tuple[int, int, str, str]]:
    """The other places where a name that was found stands as a word, as written or in capitals."""
    named: dict[str, tuple[str, str]] = {}
    for start, end, kind, value in found:
        if kind in ("name", "surname") and end - start > 1:
            for shown in (text[start:end], text[start:end].upper()):
                named.setdefault(shown, (kind, value))
    if not named:
        return
    taken = iter([*((s, e) for s, e, _, _ in found), (len(text) + 1, len(text) + 1)])
    start, end = next(taken)
    for m in re.finditer(r"[^\W\d_]+", text):
        while end <= m.start():
            start, end = next(taken)
        if m[0] in named and m.end() <= start and text[m.start() - 1 : m.start()] not in ("_", "@") and not text[m.end() : m.end() + 1].isdigit():
            yield m.start(), m.end(), *named[m[0]]


def _capitals(shown: str, drawn: str) -> str:
    """What is longer than the value ends as the value does."""
    shown += shown[-1:] * (len(drawn) - len(shown))
    return "".join(d.upper() if c.isupper() else d for c, d in zip(shown, drawn, strict=True))


def _shown_as(kind: str, shown: str, drawn: str, value: str | None = None) -> str:
    """The surrogate with the separators and capitals that the value had in the text.

    Digits before those of the value, a phone number's country, stay.
    """
    if kind in ("card", "phone"):
        before = 0 if value is None else sum(c.isdigit() for c in shown) - sum(c.isdigit() for c in value)
        digits = iter([c for c in shown if c.isdigit()][:before] + list(drawn.replace("+", "")))
        return "".join(next(digits) if c.isdigit() else c for c in shown) + "".join(digits)
    if kind == "name":
        drawn = drawn[2:]
    if kind in ("email", "name", "surname") and len(drawn) >= len(shown):
        (a, at, b), (c, _, d) = shown.partition("@"), drawn.partition("@")
        if len(a) <= len(c) and len(b) <= len(d):
            return _capitals(a, c) + at + _capitals(b, d)
    return drawn


def find(text: str) -> Iterator[tuple[int, int, str, str]]:
    """``start, end, kind, value`` of what has to be replaced, in order."""
    if not _MAYBE.search(text):
        return
    found = list(_stated(text))
    yield from sorted([*found, *_mentions(text, found)])


def _stated(text: str) -> Iterator[tuple[int, int, str, str]]:
    """What its form or the words around it give away."""
    for m in _FOUND.finditer(text):
        kind = m.lastgroup
        if kind == "ip" and any(int(o) > 255 or (len(o) > 1 and o[0] == "0") for o in m["ip"].split(".")):
            continue
        start, end = m.span(kind)
        shown = m[kind]
        if kind == "labelled" and shown.isalpha():
            continue  # a word, not a key
        if kind == "card" and shown.isdigit() and _luhn(shown):
            continue  # a number like any other
        if kind == "name":
            yield from _names(start, shown, m["form"])
        else:
            yield start, end, "secret" if kind in ("labelled", "hex") else kind, _one_form(kind, shown)


def values_of(docs: DataFrame) -> DataFrame:
    """``text_key, kind, value`` of every text (docs: text_key, text), each once a text."""

    def detect(chunk: Texts, rows: pa.RecordBatch) -> dict:
        key, kind, value = [], [], []
        for row in range(len(chunk)):
            values = {(k, v) for _, _, k, v in find(chunk.text(row))}
            for k, v in sorted(values | {("domain", v.partition("@")[2]) for k, v in values if k == "email"}):
                key.append(row)
                kind.append(k)
                value.append(v)
        return {"text_key": rows.column(0).take(pa.array(key, pa.int64())), "kind": kind, "value": value}

    return over_texts(docs, detect, "text_key long, kind string, value string")


def _draw_column(key: bytes) -> Callable:
    def drawn(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            kind, value, attempt = (batch.column(c).to_pylist() for c in ("kind", "value", "attempt"))
            got = [surrogate(key, *x) for x in zip(kind, value, attempt, strict=True)]
            yield pa.RecordBatch.from_pydict({"kind": kind, "value": value, "attempt": pa.array(attempt, pa.int32()), "drawn": got})

    return drawn


def draw_again(values: DataFrame, key: bytes) -> DataFrame:
    """``kind, value, attempt`` of the values whose first surrogate won't do.

    ``values`` are distinct. Settled surrogates stay; of several values that draw
    one, the first settles; nothing settles on a value of the corpus.
    """
    schema = "kind string, value string, attempt int, drawn string"
    taken = values.select("kind", F.col("value").alias("drawn"))
    waiting = values.select("kind", "value", F.lit(0).alias("attempt"))
    settled = None
    for _ in range(MOST_DRAWS):
        drawn = stored(waiting.mapInArrow(_draw_column(key), schema), "drawn")
        first = drawn.groupBy("kind", "drawn").agg(F.min("value").alias("value"))
        good = first.join(taken, ["kind", "drawn"], "left_anti")
        if settled is not None:
            good = good.join(settled.select("kind", "drawn"), ["kind", "drawn"], "left_anti")
        good = drawn.join(good, ["kind", "drawn", "value"], "left_semi").select(*drawn.columns)
        good = stored(good, "settled")
        waiting = drawn.join(good, ["kind", "value"], "left_anti").select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        settled = good if settled is None else settled.unionByName(good)
        if waiting.isEmpty():
            return settled.filter("attempt > 0").select("kind", "value", "attempt")
    raise RuntimeError("a kind of value has more values than surrogates")


def replace(docs: DataFrame, key: bytes, text_col: str = "text", count_col: str | None = "n_replaced") -> DataFrame:
    """``docs`` with surrogates in its texts; how many is in a column after its own."""
    columns = docs.columns
    text_key = F.xxhash64(F.col(text_col))
    found = stored(values_of(docs.select(text_key.alias("text_key"), F.col(text_col).alias("text"))), "values")
    again = stored(draw_again(found.select("kind", "value").distinct(), key), "again")
    by_text = (
        found.join(again, ["kind", "value"])
        .groupBy("text_key")
        .agg(F.collect_set(F.struct("kind", "value", "attempt")).alias("again"))
    )
    by_text = stored(by_text, "again_by_text")
    row_bytes = F.aggregate("again", F.lit(64), lambda a, x: a + 64 + F.octet_length(x["value"]))
    size = by_text.agg(F.sum(row_bytes.cast("long"))).first()[0] or 0
    hinted = F.broadcast(by_text) if size <= BROADCAST_BYTES else by_text.hint("merge")
    rows = split_off_text(docs, text_col).withColumn("text_key", F.xxhash64("_text"))
    rows = rows.join(hinted, "text_key", "left").select("_rest", "_text", "again")

    def change(chunk: Texts, batch: pa.RecordBatch) -> dict:
        texts, counts = [], []
        nulls = batch.column(1).is_null().to_pylist()
        drawn_again = batch.column(2).to_pylist()
        for row in range(len(chunk)):
            own = {(x["kind"], x["value"]): x["attempt"] for x in drawn_again[row] or ()}
            text, out, last, n = chunk.text(row), [], 0, 0
            for start, end, kind, value in find(text):
                host = own.get(("domain", value.partition("@")[2]), 0) if kind == "email" else 0
                drawn = surrogate(key, kind, value, own.get((kind, value), 0), host)
                out += [text[last:start], _shown_as(kind, text[start:end], drawn, value)]
                last, n = end, n + 1
            texts.append(None if nulls[row] else text if not n else "".join(out) + text[last:])
            counts.append(n)
        return {"_rest": batch.column(0), "_text": texts, "n_replaced": counts}

    out_schema = rows.select("_rest", "_text", F.lit(0).cast("int").alias("n_replaced")).schema
    changed = over_texts(rows, change, out_schema, column="_text")
    counted = [] if count_col is None else [F.col("n_replaced").alias(count_col)]
    return changed.select(*joined_with_text(columns, text_col), *counted)

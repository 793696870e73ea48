import re

import pytest
import tricky

import __spark_entry__ as entry
from vacancylens.llm import pii

KEY = b"tests"


def replaced(spark, *texts):
    rows = pii.replace(tricky.texts(spark, *enumerate(texts)), KEY).collect()
    return [r.text for r in sorted(rows, key=lambda r: r.doc_id)]


def test_formats_stay_and_values_go(spark):
    text = (
        "Mail Anna.Smith42@Mail.example.com, call +1 (555) 555-0123 or 555-867-5309, card 4111 1111 1111 1111,\n"
        "host 10.200.3.44. token = \"0123456789abcdef0123456789abcdef01234567\" and api_key: AbC123xyz789QQ"
    )
    (got,) = replaced(spark, text)
    shape = re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", text)))
    for secret in re.findall(r"[\w.]+@\S+\w|\d{3}-\d{4}|10\.200\S+|[0-9a-f]{40}|AbC\w+|4111[ \d]+", text):
        assert secret not in got
    assert len(got) == len(text) and got.startswith("Mail ") and ".example.com, call +1 (" in got
    assert re.search(r"card 4\d{3} \d{4} \d{4} \d{4},", got)
    digits = re.sub(r"\D", "", re.search(r"card ([\d ]+)", got)[1])
    assert pii._luhn(digits) == 0
    assert all(int(o) <= 255 for o in re.search(r"host ([\d.]+)\. ", got)[1].split("."))
    assert re.search(r"[A-Z][a-z]{3}\.[A-Z][a-z]{4}\d\d@[A-Z][a-z]{3}\.example", got) and shape


def test_one_value_one_surrogate_in_all_forms(spark):
    got = replaced(spark, "a A@b.org 4111111111111111", "b a@b.org 4111-1111-1111-1111", "other c@b.org")
    first, second = got[0].split(), got[1].split()
    assert first[1].lower() == second[1] and first[2] == second[2].replace("-", "")
    assert got[2].split()[1] != second[1] and got[2].split("@")[1] == second[1].split("@")[1]


def test_gender_and_script(spark):
    got = replaced(spark, "Frau Maria Klein und Herr Klein", "господин Иванов и госпожа Иванова", "Mr Smith met Mr Smith")
    # A given name shows the gender; the surname is one, whoever bears it.
    m = re.fullmatch(r"Frau ([A-Z][a-z]{3}a) ([A-Z][a-z]{3}n) und Herr ([A-Z][a-z]{3}n)", got[0])
    assert m and "Klein" not in got[0] and m[2] == m[3]
    assert re.fullmatch(r"господин [А-Я][а-я]{4}н и госпожа [А-Я][а-я]{5}а", got[1])
    a, b = re.fullmatch(r"Mr (\w+) met Mr (\w+)", got[2]).groups()
    assert a == b != "Smith"


@pytest.mark.parametrize(
    "text",
    ["version 1.2.3.4.5", "pi 3.14159265", "in 2020 and 1999", "a@b", "300.1.2.3", "token = something", "Sir, no", "12345678"],
)
def test_plain_texts_stay(text):
    assert list(pii.find(text)) == []


def test_long_runs_take_no_time():
    for run in ("x" * 400_000, "x." * 200_000, "0" * 400_000, "a1" * 200_000, "@" * 100_000, "token" + " " * 400_000):
        assert len(list(pii.find(run + " 1"))) <= 1


def test_collisions_draw_again(spark, monkeypatch):
    values = [("ip", f"{k}.{m}.{n}.{p}") for k in range(1, 4) for m in range(4) for n in range(4) for p in range(4)]
    frame = spark.createDataFrame([(f"{k}{v}", v) for k, v in values], "kind string, value string")
    # One-digit octets: 10,000 addresses for 192 values of each kind of three.
    frame = frame.selectExpr("'ip' AS kind", "value").distinct()
    again = {(r.kind, r.value): r.attempt for r in pii.draw_again(frame, KEY).collect()}
    drawn = {v: pii.surrogate(KEY, "ip", v, again.get(("ip", v), 0)) for _, v in values}
    assert len(set(drawn.values())) == len(drawn) and not set(drawn.values()) & set(drawn)
    assert again


def test_drawn_again_values_reach_the_texts(spark):
    values = [f"{k}.{m}.{n}.{p}" for k in range(1, 4) for m in range(4) for n in range(4) for p in range(4)]
    got = [t.split()[1] for t in replaced(spark, *(f"host {v} up" for v in values))]
    assert len(set(got)) == len(values) and not set(got) & set(values)


def test_too_few_surrogates_fail(spark, monkeypatch):
    monkeypatch.setattr(pii, "MOST_DRAWS", 2)
    many = spark.createDataFrame([("ip", f"{a}.{b}.{c}.1") for a in range(1, 10) for b in range(10) for c in range(10)], "kind string, value string")
    with pytest.raises(RuntimeError, match="more values than surrogates"):
        pii.draw_again(many, KEY)


def test_odd_rows(spark):
    docs = tricky.documents(spark)
    got = pii.replace(docs, KEY)
    assert got.columns == [*docs.columns, "n_replaced"]
    before = {(r["doc_id"], r["text"], r["a.b"], r["text_key"]) for r in docs.collect()}
    assert {(r["doc_id"], r["text"], r["a.b"], r["text_key"]) for r in got.collect()} == before
    assert got.count() == len(tricky.TEXTS) and got.agg({"n_replaced": "sum"}).first()[0] == 0
    assert pii.replace(docs.limit(0), KEY, count_col=None).columns == docs.columns
    assert pii.replace(docs.limit(0), KEY).count() == 0


def test_query_leaves_no_planted_value(spark):
    sf = "/root/testdata/sf0.001"
    planted = re.compile(r"[\w.]+@\w+\.example\.com|\+1 \(\d+\) \d{3}-\d{4}|(?<!\d)\d{16}(?!\d)|[0-9a-f]{40}")
    got = dict(entry.queries()["op9_surrogates"](spark, sf).select("doc_id", "text").collect())
    found = 0
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        values = [v for v in planted.findall(row.text) if not (v.isdigit() and pii._luhn(v))]  # other numbers stay
        found += len(values)
        assert not any(v in got[row.doc_id] for v in values)
        if not re.search(r"[@0-9]", row.text):
            assert got[row.doc_id] == row.text
    assert found


def test_crowded_short_values_settle(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    values = [("email", f"{a}@b.org") for a in letters] + [("email", f"{a}{b}@mail.example.com") for a in letters for b in letters]
    values += [("name", f"m:{a}{b}") for a in letters for b in letters] + [("phone", f"1+{k:04d}") for k in range(10_000)]
    values += [("secret", "-----------" + d) for d in "0123456789"] + [("secret", "." * 12)]
    values += [("ip", f"{a}.{b}.{c}.{d}") for a in range(10) for b in range(10) for c in range(10) for d in range(6)]
    frame = spark.createDataFrame(values, "kind string, value string")
    again = {(r.kind, r.value): r.attempt for r in pii.draw_again(frame, KEY).collect()}
    drawn = [(kind, pii.surrogate(KEY, kind, value, again.get((kind, value), 0))) for kind, value in values]
    assert len(set(drawn)) == len(values) and not set(drawn) & set(values)
    assert all(len(d) <= len(v) + 8 for (_, d), (_, v) in zip(drawn, values, strict=True))


def test_longer_surrogates_reach_the_texts(spark):
    texts = [f"to {a}@Box.org now" for a in "abcdefghijklmnopqrstuvwxyz"] + [f"Mr {a}i came" for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    got = replaced(spark, *texts)
    assert len(set(got)) == len(texts) and not set(got) & set(texts)
    hosts = {re.fullmatch(r"to [a-z]+@([A-Z][a-z]{2}\.org) now", t)[1] for t in got[:26]}
    assert len(hosts) == 1 and all(re.fullmatch(r"Mr [A-Z][a-z]*n came", t) for t in got[26:])


def test_longer_forms_are_shown():
    for kind, shown, value in (("card", "4111 1111 1111 1111", "4111111111111111"), ("phone", "+1 23 45", "1+2345")):
        drawn = pii.surrogate(KEY, kind, value, pii.SAME_LENGTH + 1)
        put = pii._shown_as(kind, shown, drawn)
        assert re.sub(r"\D", "", put) == drawn.replace("+", "") and len(put) == len(shown) + 2
    assert pii._luhn(pii.surrogate(KEY, "card", "4111111111111111", pii.SAME_LENGTH + 2)) == 0
    assert pii.surrogate(KEY, "ip", "1.2.3.4", pii.MOST_DRAWS - 1).startswith("2001:db8:")


@pytest.mark.parametrize(
    "before, after",
    [
        ("API_KEY=", ""), ("Token: ", ""), ('PASSWORD = "', '"'), ('{"Secret": "', '"}'), ("Access-Key=", ""), ("PWD:", ""),
        ("Authorization: Bearer ", "\n"), ("authorization: bearer ", ""), ("BEARER ", ""), ("token: Bearer ", ""),
    ],
)
def test_labels_of_secrets_in_any_case(before, after):
    text = f"x\n{before}qT.zz-Abc123xyz{after}"
    assert [(text[a:b], kind) for a, b, kind, _ in pii.find(text)] == [("qT.zz-Abc123xyz", "secret")]


def test_words_after_bearer_stay_and_long_runs_take_no_time():
    assert not any(list(pii.find(t)) for t in ("the bearer responsibilities", "Bearer well-established-thing", "BEARER of a"))
    for run in ("bearer" + " " * 400_000, "bearer " * 60_000, "Bearer " + "z" * 400_000, "token=Bearer" + " " * 400_000):
        assert list(pii.find(run + " 1")) == []


def test_all_mentions_of_a_person_agree(spark):
    text = "Mr John Smith wrote. Mr Smith left. Smith came back with JOHN, and Dr Smith-Jones. smith and Smithson, Smith2 stay. Smith"
    got = replaced(spark, text, "Prof. Smith and Frau Dr Eva Smith")
    m = re.fullmatch(
        r"Mr (\w+) (\w+) wrote\. Mr (\w+) left\. (\w+) came back with (\w+), and Dr (\w+)-(\w+)\. smith and Smithson, Smith2 stay\. (\w+)", got[0]
    )
    john, smith = m[1], m[2]
    assert {m[3], m[4], m[6], m[8]} == {smith} and m[5] == john.upper() and len({john, smith, m[7], "John", "Smith", "Jones"}) == 6
    assert re.fullmatch(rf"Prof\. {smith} and Frau Dr \w+ {smith}", got[1]) and "Eva" not in got[1]


def test_one_phone_number_with_and_without_its_country(spark):
    got = replaced(spark, "(415) 555-2671", "+1 415 555 2671", "+14155552671", "+1 (415) 555-2671", "+49 415 555 2671")
    national = re.sub(r"\D", "", got[0])
    assert national != "4155552671" and len(national) == 10
    assert [re.sub(r"\D", "", t) for t in got] == [national, "1" + national, "1" + national, "1" + national, "49" + national]
    assert re.fullmatch(r"\(\d{3}\) \d{3}-\d{4}", got[0]) and re.fullmatch(r"\+1 \d{3} \d{3} \d{4}", got[1])


def test_bare_digits_need_the_check_digit():
    assert list(pii.find("order 4111111111111112 and 1234567890123")) == []
    for text in ("4111111111111111", "4111 1111 1111 1112"):
        assert [(k, v) for _, _, k, v in pii.find(text)] == [("card", text.replace(" ", ""))]


def test_hosts_stay_distinct(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [f"x{n}@{a}{b}.org" for n, (a, b) in enumerate((a, b) for a in letters for b in letters)]
    got = replaced(spark, *texts)
    hosts = [t.partition("@")[2] for t in got]
    assert len(set(hosts)) == len(texts) and not set(hosts) & {t.partition("@")[2] for t in texts}
    assert all(h.endswith(".org") for h in hosts)


def test_addresses_stay_addresses_of_their_kind():
    for attempt in range(pii.MOST_DRAWS - pii.LAST_DRAWS - 1):
        assert re.fullmatch(r"\d+(\.\d+){3}", pii.surrogate(KEY, "ip", "1.2.3.4", attempt))


def test_equals_a_plain_replacement(spark):
    """A table small enough to see all of it: one mapping from values to surrogates explains all texts."""
    texts = ["Mr Ann Lee, a@b.org", "Lee (212) 555-0100 and +1 212 555 0100", "Mr Lee and Lee: 10.0.0.1, a@b.org, A@B.org", "4111 1111 1111 1111; 10.0.0.1"]
    got, mapping = replaced(spark, *texts), {}
    for before, after in zip(texts, got, strict=True):
        spans, at = list(pii.find(before)), 0
        pattern = ""
        for start, end, _, _ in spans:
            pattern += re.escape(before[at:start]) + "(.+?)"
            at = end
        m = re.fullmatch(pattern + re.escape(before[at:]), after)
        for (start, end, kind, value), shown in zip(spans, m.groups(), strict=True):
            plain = shown.lower() if kind in ("email", "name", "surname") else re.sub(r"\D", "", shown)[-10:] if kind == "phone" else shown
            assert mapping.setdefault((kind, value), plain) == plain
    assert len(set(mapping.values())) == len(mapping) == 6 and {k for k, _ in mapping} == {"name", "surname", "email", "phone", "ip", "card"}

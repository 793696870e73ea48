import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vacancylens.fixed_values import SPECIAL_NAMES
from vacancylens.functions import numbers, text, times

WORDS = [
    "businessAnalyst", "ux/ui", "żAx", "DevOPS", "it's o'neil", ".net", "a1b", "", "nan", "中a", "łódź", "SQL",
    "node.js", "ABCd", "a  b", " lead", "x_Y", "ß", "ǆx", "sql", "B2B", "b2b",
]


def apply(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", expression(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


def test_split_before_capitals_matches_python(spark):
    assert apply(spark, WORDS, text.split_before_capitals) == [re.sub(r"(\w)([A-Z])", r"\1 \2", w) for w in WORDS]


def test_title_case_matches_python(spark):
    assert apply(spark, WORDS, text.title_case) == [w.title() for w in WORDS]


def test_capitalize_with_special_names(spark):
    expected = [SPECIAL_NAMES.get(w, w.capitalize()) for w in WORDS]
    assert apply(spark, WORDS, lambda c: text.capitalize(c, SPECIAL_NAMES)) == expected


def test_text_functions_keep_null(spark):
    for function in (text.split_before_capitals, text.title_case, text.capitalize, text.keyword):
        assert apply(spark, [None], function) == [None]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.characters(codec="latin-1", exclude_categories=["Cc"]), max_size=12), min_size=1, max_size=40))
def test_text_functions_property(spark, words):
    # Letters without case in Latin-1 (ª, º) count as lower case in both.
    assert apply(spark, words, text.title_case) == [w.title() for w in words]
    assert apply(spark, words, text.capitalize) == [w.capitalize() for w in words]


def test_text_functions_over_all_european_letters(spark):
    letters = [chr(c) for c in range(0x20, 0x530) if chr(c).isprintable() and c != 0x19B and c != 0x264]
    words = [c + "b" for c in letters] + ["a" + c + "Bc" for c in letters]
    assert apply(spark, words, text.title_case) == [w.title() for w in words]
    assert apply(spark, words, text.capitalize) == [w.capitalize() for w in words]
    assert apply(spark, words, text.split_before_capitals) == [re.sub(r"(\w)([A-Z])", r"\1 \2", w) for w in words]


def test_keyword_strips_all_white_space(spark):
    assert apply(spark, ["\n  Python\t", " Go "], text.keyword) == ["python", "go"]


def test_yes_no(spark):
    assert apply(spark, [True, False, None], text.yes_no, "boolean") == ["Yes", "No", None]


def test_address_parts(spark):
    rows = ["Warszawa, województwo mazowieckie, Polska", "Polska"]
    assert apply(spark, rows, lambda c: F.concat_ws("|", *text.address_city_country(c))) == [
        "Warszawa|Polska",
        "Polska|Polska",
    ]


def test_replace_is_one_pass_and_whole_cell(spark):
    df = spark.createDataFrame([("react", ["react"], 1), ("react native", ["x"], 2), ("a", [], 3)], "t string, l array<string>, n int")
    out = text.replace_values(df, {"react": "a", "a": "b"}).collect()
    assert [(r.t, r.l) for r in out] == [("a", ["react"]), ("react native", ["x"]), ("b", [])]
    assert text.replace_values(df.withColumn("u", F.col("t")), {"react": "a"}, subset=["u"]).first().t == "react"


def test_unify_missing(spark):
    df = spark.createDataFrame([("", float("nan")), ("NaN", 1.0), ("Nan", None), ("nan", 2.0), ("NAN", 3.0)], "t string, d double")
    assert [tuple(r) for r in text.unify_missing(df).collect()] == [
        (None, None), (None, 1.0), (None, None), (None, 2.0), ("NAN", 3.0)
    ]


def test_row_mean_skips_missing(spark):
    rows = [(1.0, 2.0), (3.0, None), (None, 4.0), (None, None), (float("nan"), 5.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    out = [r[0] for r in df.select(numbers.row_mean(F.col("a"), F.col("b"))).collect()]
    assert out == [1.5, 3.0, 4.0, None, 5.0]


def test_magnitude_bin_keeps_order(spark):
    values = sorted([0.0, -1e300, -1.0, -1e-300, 5e-324, 1e-10, 0.5, 1.0, 1.001, 2.0, 99.99, 100.0, 1e308, float("inf"), float("-inf")])
    bins = apply(spark, values, numbers.magnitude_bin, "double")
    assert bins == sorted(bins) and bins[values.index(0.0)] == 0
    assert apply(spark, [-1.0, 1.0], numbers.magnitude_bin, "double") == [-bins[values.index(1.0)], bins[values.index(1.0)]]


def test_times_need_a_full_date(spark):
    texts = ["2021", "2021-12", "2021-12-01", "2021-12-01T08:30:05", "2021-12-01 25:00:00", "12:30", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string").select(times.parse_iso(F.col("v")).alias("t"))
    assert [r.t is not None for r in df.collect()] == [False, False, True, True, False, False, False, False]


def test_snapshot_key_and_times(spark):
    df = spark.createDataFrame([("2021-12-01 08:30:05",)], "v string").select(times.parse_iso(F.col("v")).alias("t"))
    row = df.select(
        times.snapshot_key(F.col("t"), F.lit("nofluffjobs")).alias("key"),
        times.format_iso(F.col("t")).alias("iso"),
        times.display_date(F.col("t")).alias("shown"),
        F.date_format(times.from_epoch_millis(F.lit(1640995200123)), "yyyy-MM-dd HH:mm:ss.SSS").alias("posted"),
    ).first()
    assert row.key == "1638347405_nofluffjobs"
    assert row.iso == "2021-12-01 08:30:05"
    assert row.shown == "1 December 2021"
    assert row.posted == dt.datetime.fromtimestamp(1640995200.123, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.123")

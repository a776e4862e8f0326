import datetime as dt
import math
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oreworks import functions as fn
from oreworks.functions.calendar import calendar_columns
from oreworks.functions.text import ACCOUNT_CHARS, CARD_DIGITS


def apply(spark, function, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in rows.select("i", function("v").alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "function, cases",
    [
        (
            fn.mask_card,
            {
                "4111111111111111": "************1111",
                "123": "123",
                "12345": "*2345",
                "4111-1111-1111-1234": "4111-1111-1111-1234",
                None: None,
            },
        ),
        (
            fn.mask_card_strict,
            {"4111-1111-1111-1234": "****-****-****-1234", "12 34 5": "*2 34 5", "12-34": "12-34"},
        ),
        (
            fn.mask_account,
            {
                "alice@x.com": "ali**@x.com",
                "ab@x.com": "ab@x.com",
                "nomail": "nomail",
                "abcd@ef@gh": "abc****@gh",
                "abc@x": "abc@x",
                "abcd@x": "abc*@x",
                "": "",
                "@": "@",
                "aaaa@": "aaa*@",
                None: None,
            },
        ),
        (fn.tidy, {"  a b ": "a b", "": "", None: None}),
        (fn.tidy_upper, {"  a b ": "A B", None: None}),
        (
            fn.as_date,
            {"1999-12-31": dt.date(1999, 12, 31), "31/12/1999": None, "": None, None: None},
        ),
        (fn.as_double, {"4.5": 4.5, "x": None, "": None, None: None}),
    ],
)
def test_text_functions(spark, function, cases):
    assert apply(spark, function, list(cases)) == list(cases.values())


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.text(st.sampled_from("ab1@.\n\r\u0085 \U0001f600 "), max_size=14),
        min_size=60,
        max_size=60,
    )
)
def test_account_mask_by_position_equals_the_pattern(spark, texts):
    want = apply(spark, lambda c: F.regexp_replace(c, ACCOUNT_CHARS, "*"), texts)
    assert apply(spark, fn.mask_account, texts) == want


def test_mask_account_by_line_is_the_pattern(spark):
    """Lines of any length, breaks of any kind, letters beyond ASCII."""
    rng = random.Random(5)
    letters = "ab@é漢ß \n\r\u0085\u2028\u2029"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(2000)]
    texts += ["äbc@\n", "\n\nabcdé@", "abcé\r\nxyz@@\r\n", "😀abcd@x", "ab😀cd@x", "é" * 6 + "@😀@"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    by_pattern = F.regexp_replace("t", ACCOUNT_CHARS, "*")
    got = rows.select(fn.mask_account("t").alias("a"), by_pattern.alias("b"))
    assert got.filter("NOT a <=> b").collect() == []


def test_mask_account_of_a_long_line_is_linear(spark):
    rows = spark.createDataFrame([("é" * 2_000_000 + "@x",)], "t string")
    masked = fn.mask_account("t")
    row = rows.select(F.length(masked), F.right(masked, F.lit(4)))
    assert tuple(row.first()) == (2_000_002, "**@x")


def test_masks_on_whole_documents(spark):
    """Free text with line breaks and e-mail addresses, against a mask written by hand."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    rows = docs.select(
        "text", fn.mask_account("text").alias("a"), fn.mask_card("text").alias("c")
    ).collect()

    def account(line):
        last = line.rfind("@")
        return line[:3] + "*" * (last - 3) + line[last:] if last > 3 else line

    for text, masked, card in rows:
        parts = re.split("([\n\r\u0085  ])", text)
        assert masked == "".join(account(p) for p in parts)
        assert card == re.sub(CARD_DIGITS, "*", text, flags=re.ASCII)


def test_range_bucket_truncates_toward_zero(spark):
    values = [-19999999, -1, 0, 9999999, 10000000, None, 2**60 + 1]
    got = apply(spark, lambda c: fn.range_bucket(c, 10_000_000), values[:-1], "bigint")
    assert got == [-1, 0, 0, 0, 1, None]
    exact = apply(spark, lambda c: fn.range_bucket(c, 2**40), values[-1:], "bigint")
    assert exact == [2**20]


def test_calendar_columns(spark):
    days = [dt.date(2021, 1, 3), dt.date(2024, 1, 7), dt.date(2024, 6, 30), dt.date(2024, 7, 1)]
    rows = spark.createDataFrame([(d,) for d in days], "date date")
    got = [r.asDict() for r in rows.select(*calendar_columns("date")).collect()]
    assert tuple(got[0]) == fn.CALENDAR_COLUMNS
    assert got[0]["week_of_year"] == 53
    assert got[1]["day_of_week"] == 1 and got[1]["is_weekend"] and got[1]["day_name"] == "Sunday"
    assert [g["fiscal_year"] for g in got] == [2021, 2024, 2024, 2025]
    assert [g["is_winter"] for g in got] == [True, True, False, False]
    assert [g["is_summer"] for g in got] == [False, False, True, True]


def test_ages_and_days(spark):
    born = spark.createDataFrame([(dt.date(2000, 7, 1),), (None,)], "born date")
    as_of = F.lit(dt.date(2025, 1, 1))
    rows = born.select(
        fn.age_in_years("born", as_of), fn.age_exact("born", as_of), fn.days_since("born", as_of)
    ).collect()
    assert [tuple(r) for r in rows] == [(25, 24, 8950), (None, None, None)]


@pytest.mark.parametrize(
    "amounts,total",
    [
        ([1.005], 1.005),
        ([0.1] * 10, 1.0),
        ([1e17, 0.01], 1e17 + 0.01),
        ([1e300, 1.0], 1e300),
        ([float("inf"), 1.0, None], float("inf")),
        ([None], None),
    ],
)
def test_money_adds_up(spark, amounts, total):
    df = spark.createDataFrame([(a,) for a in amounts], "a double")
    assert df.agg(fn.money_sum("a")).first()[0] == total


def test_money_keeps_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "a double")
    assert math.isnan(df.agg(fn.money_sum("a")).first()[0])

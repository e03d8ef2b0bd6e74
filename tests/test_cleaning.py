import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from goldvein.functions import cleaning as c


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        (None, ""),
        ("   ", ""),
        ("  ab  cd ", "ab  cd"),
        ("$1234.50", "123450"),
        (" 10% ", "10"),
        ("A&B: x, y-z", "A&B: x, y-z"),
        ("Électro", "lectro"),
        ("/data/in_1.csv", "datain1csv"),
        ("tab\there", "tabhere"),
        ("2024-01-01 10:20:30", "2024-01-01 10:20:30"),
    ],
)
def test_clean_text(frame, raw, cleaned):
    df = frame([(raw,)], "v string")
    assert df.select(c.clean_text(F.col("v"))).first()[0] == cleaned


def test_clean_text_options(frame):
    df = frame([("É $12.50",)], "v string")
    row = df.select(
        c.clean_text(F.col("v"), fold=True).alias("folded"),
        c.clean_text(F.col("v"), c.NOT_KEPT_WITH_POINT).alias("pointed"),
    ).first()
    assert row.folded == "E 1250"
    assert row.pointed == " 12.50"


def test_nulls_by_type(frame):
    schema = (
        "i int, l long, d double, m decimal(10,2), day date, ts timestamp, nts timestamp_ntz,"
        " b boolean, a array<int>, s string"
    )
    df = frame([(None,) * 10], schema)
    cleaned = c.clean_frame(df)
    assert [f.dataType for f in cleaned.schema] == [f.dataType for f in df.schema]
    row = cleaned.first()
    assert (row.i, row.l, row.d, row.m, row.s) == (0, 0, 0.0, 0, "")
    assert row.day == date(1900, 1, 1)
    assert row.ts == row.nts == datetime(1900, 1, 1)
    assert row.b is None and row.a is None


def test_technical_columns_pass(frame):
    df = frame([("/a/b_1.csv", "/a/b_1.csv")], "_source_file string, other string")
    row = c.clean_frame(df).first()
    assert row._source_file == "/a/b_1.csv" and row.other == "ab1csv"
    assert c.clean_frame(df, skip=()).first()._source_file == "ab1csv"


def test_case_and_phone(frame):
    df = frame([("ab", "CD", "9876543210.0"), (None, None, None)], "u string, l string, p string")
    rows = c.phone_columns(c.lower_columns(c.upper_columns(df, ["u"]), ["l"]), ["p"]).collect()
    assert tuple(rows[0]) == ("AB", "cd", "9876543210")
    assert tuple(rows[1]) == (None, None, None)


def test_units_and_words(frame):
    df = frame([("250g", "12,5", "Two"), ("1 kg 5", "3", "3")], "w string, l string, q string")
    fixed = c.replace_values(df, "q", {"Two": "2"}).select(
        c.digits_only(F.col("w")), c.decimal_point(F.col("l")), "q"
    )
    assert [tuple(r) for r in fixed.collect()] == [("250", "12.5", "2"), ("15", "3", "3")]


def test_leading_columns(frame):
    df = frame([(1, 2, 3)], "a int, b int, c int")
    assert c.leading_columns(df, ["c"]).columns == ["c", "a", "b"]


@pytest.mark.parametrize("kept, ranges", [(c.NOT_KEPT, r"[^a-zA-Z0-9&:\-, ]"), (c.NOT_KEPT_WITH_POINT, r"[^a-zA-Z0-9&:\-,. ]")])
def test_characters_are_named_one_by_one(kept, ranges):
    every = "".join(map(chr, range(0x3000)))
    assert re.sub(kept, "", every) == re.sub(ranges, "", every)
    assert "a-z" not in kept and "0-9" not in kept  # Java tries ranges one after the other

"""Column functions on single values."""

import pytest
from pyspark.sql import functions as F

from loomgraph.functions import columns


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("0000-0002-1825-009X", "https://orcid.org/0000-0002-1825-009X"),
        ("https://orcid.org/0000000218250097", "https://orcid.org/0000-0002-1825-0097"),
        (" http://orcid.org/0000-0002-1825-0097 ", "https://orcid.org/0000-0002-1825-0097"),
        ("1234", None),
        ("", None),
        (None, None),
    ],
)
def test_orcid(spark, text, wanted):
    assert one(spark, columns.normalize_orcid, text) == wanted


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("2023-02-08 09:06:15", "2023-02-08 09:06:15"),
        ("8.2.23 9:06 AM", "2023-02-08 09:06:00"),
        ("8.2.23 9:06 pm", "2023-02-08 21:06:00"),
        ("8.2.23 09:06", "2023-02-08 09:06:00"),
        ("08.02.2023 09:06:15", "2023-02-08 09:06:15"),
        ("08.02.2023 09:06", "2023-02-08 09:06:00"),
        ("8.2.23 9:06AM", "2023-02-08 09:06:00"),
        ("1.1.85 10:00", "1985-01-01 10:00:00"),
        ("soon", None),
        (None, None),
    ],
)
def test_timestamps(spark, text, wanted):
    found = one(spark, columns.parse_timestamp, text)
    assert (found and str(found)) == wanted


@pytest.mark.parametrize(("text", "wanted"), [("6.9", 6.9), ("6.9°", 6.9), ("<001>, 6.9 deg", 6.9), ("<001> 6.9", 6.9), ("see " + "x" * 60, None), ("about 3", None)])
def test_orientation(spark, text, wanted):
    assert one(spark, columns.parse_orientation, text) == wanted


@pytest.mark.parametrize(("text", "wanted"), [("980", 980.0), (" 1e3 ", 1000.0), ("1d", None), ("1_000", None), ("nan", None), ("", None)])
def test_numbers(spark, text, wanted):
    assert one(spark, columns.parse_number, text) == wanted


def test_percent(spark):
    assert one(spark, columns.parse_percent, "1.5%") == pytest.approx(0.015)


def test_clean_text(spark):
    assert one(spark, columns.clean_text, "a <b>bold</b>\n  c ") == "a bold c"
    long = one(spark, lambda c: columns.clean_text(c, 3), "1 2 3 4")
    assert long == "1 2 3..."


def test_emptyish(spark):
    for text in (None, " NULL", "", "()", "[]", " {} "):
        assert one(spark, lambda c: columns.otherwise(c, F.lit("b")), text) == "b"
    assert one(spark, lambda c: columns.otherwise(c, F.lit("b")), "a") == "a"


def test_duration(spark):
    def of(a, b):
        df = spark.createDataFrame([(a, b)], "a string, b string").select(columns.iso_duration(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")).alias("x"))
        return df.first()["x"]

    assert of("2023-02-08 09:06:15", "2023-02-11 15:48:15") == "P3DT6H42M"
    assert of("2023-02-08 09:06:15", "2023-02-08 09:06:15") == "PT0S"
    assert of("2023-02-09 00:00:00", "2023-02-08 00:00:00") == "PT0S"
    assert of("2023-02-08 00:00:00", "2023-02-10 00:00:01") == "P2DT1S"


def test_number_text(spark):
    assert one(spark, columns.number_text, 980.0, "double") == "980.0"
    assert one(spark, columns.number_text, 1e7, "double") == "10000000.0"
    assert one(spark, columns.number_text, 0.015, "double") == "0.015"


def test_number_text_keeps_all_digits(spark):
    for x in (0.07 / 100, 0.0001, 0.0009, 0.02 / 30, 12345678.123456789, 123456789012.37, 9007199254740992.0):
        assert one(spark, columns.number_text, x, "double") == repr(x)

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bankspark.functions import cleanse, dates, numbers, rules
from tests.util import bag, frame, ts


@pytest.mark.parametrize(
    "raw, want",
    [
        ("  priya patel  ", "Priya Patel"), ("LA DÉFENSE", "La Défense"), ("o'brien-smith", "O'brien-Smith"),
        ("single", "Single"), ("a.b/c", "A.B/C"), ("north  america", "North  America"), (None, None), ("", ""),
    ],
)
def test_display_names(spark, raw, want):
    df = frame(spark, "c string", (raw,))
    assert df.select(cleanse.norm_name(F.col("c"))).first()[0] == want


def test_names_by_white_space_only(spark):
    df = frame(spark, "c string", ("jean-luc picard",))
    assert df.select(cleanse.norm_name(F.col("c"), None)).first()[0] == "Jean-luc Picard"


def test_codes_defaults_and_enums(spark):
    df = frame(spark, "c string", (" high ",), ("x",), (None,))
    got = df.select(
        cleanse.norm_code(F.col("c")), cleanse.default_unknown(F.col("c")),
        cleanse.canonical(F.col("c"), ("LOW", "HIGH")),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("HIGH", "HIGH", "HIGH"), ("X", "X", "UNKNOWN"), (None, "UNKNOWN", "UNKNOWN"),
    ]


def test_surrogate_key_separates_null_from_text(spark):
    df = frame(spark, "a string, b string", ("x", None), ("x", "null"), ("x", ""))
    keys = {r[0] for r in df.select(cleanse.surrogate_key(F.col("a"), F.col("b"))).collect()}
    assert len(keys) == 3


def test_serial_dates(spark):
    df = frame(spark, "c string", ("45123",), (" 2023-07-16 ",), ("n/a",), (None,), ("451234",))
    got = [str(r[0]) for r in df.select(cleanse.parse_date_or_serial(F.col("c"))).collect()]
    assert got == ["2023-07-16", "2023-07-16", "None", "None", "None"]


def test_boundary_differences(spark):
    df = frame(spark, "a timestamp_ntz, b timestamp_ntz", (ts("2024-01-31 10:59:59"), ts("2024-02-01 11:00:00")))
    got = df.select(
        dates.months_between_boundaries(F.col("a"), F.col("b")),
        dates.months_between_boundaries(F.col("b"), F.col("a")),
        dates.minutes_between_boundaries(F.col("a"), F.col("a") + F.expr("interval 1 second")),
    ).first()
    assert tuple(got) == (1, -1, 1)


def test_null_strict_extremes_and_safe_ratios(spark):
    df = frame(spark, "a int, b int, x decimal(18,2), y decimal(18,2)",
               (1, None, Decimal("1.00"), Decimal("0.00")), (1, 2, Decimal("1.00"), Decimal("3.00")))
    got = df.select(
        numbers.greatest_strict(F.col("a"), F.col("b")), numbers.least_strict(F.col("a"), F.col("b")),
        numbers.ratio_pct(F.col("x"), F.col("y")),
    ).collect()
    assert [tuple(r) for r in got] == [(None, None, None), (2, 1, Decimal("33.33"))]


def test_rule_edges(spark):
    df = frame(spark, "v decimal(18,2)", (Decimal("24999.99"),), (Decimal("25000.00"),), (Decimal("50000.40"),), (Decimal("50500.00"),))
    got = bag(df.select("v", rules.is_high_value(F.col("v"), 25000), rules.is_round_high_value(F.col("v"), 50000)))
    assert [(g[1], g[2]) for g in got] == [(0, 0), (1, 0), (1, 1), (1, 0)]


def test_cdc_operation(spark):
    df = frame(spark, "a string, u boolean", ("INSERT", True), ("DELETE", True), ("INSERT", False), ("DELETE", False), ("X", True), ("INSERT", None))
    got = [r[0] for r in df.select(rules.cdc_operation(F.col("a"), F.col("u"))).collect()]
    assert got == ["UPDATE", "UPDATE", "INSERT", "DELETE", None, "INSERT"]


def test_annuity(spark):
    df = frame(spark, "p decimal(18,2), r decimal(6,2), m int", (Decimal("100000"), Decimal("12.00"), 12))
    assert df.select(numbers.annuity_emi(F.col("p"), F.col("r"), F.col("m"))).first()[0] == Decimal("8884.88")

"""Column expressions: the reference's own test cases plus edge cases."""

import math

import pytest
from pyspark.sql import functions as F

from rxcover import functions as fx


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")


def evaluate(spark, values, expr, typ="string"):
    df = one_col(spark, values, typ)
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


# FIXED VALUES: inputs and results that must stay exactly as written.
def test_strip_namespace_reference_cases(spark):
    cases = ["{http://www.w3.org/2001/XMLSchema}tag", "tag", "{namespace}element", ""]
    assert evaluate(spark, cases, fx.strip_namespace) == ["tag", "tag", "element", ""]


def test_strip_namespace_last_brace_and_null(spark):
    assert evaluate(spark, ["{a}{b}c", "x}", None], fx.strip_namespace) == ["c", "", None]


def test_trim_text_matches_python_strip(spark):
    values = [" a ", "　x\xa0", "\x1cq\x1f", "\t\n y \r", "", "ab", "  µg  ", "\x85z "]
    assert evaluate(spark, values + [None], fx.trim_text) == [v.strip() for v in values] + [None]


# FIXED VALUES: inputs and results that must stay exactly as written.
@pytest.mark.parametrize("value,unit,expected", [
    (1.5, "g", 1500.0), (500.0, "mg", 500.0), (250.0, "microgram", 0.25), (100.0, "mcg", 0.1),
    (2.0, " G ", 2000.0), (3.0, "MG", 3.0),
    (None, "g", None), (float("nan"), "g", None),
    (3.0, "MU", None), (1.0, "unit", None), (500.0, "ml", None),
    (2.0, "kg", 2_000_000.0), (5.0, "ng", 5.0 / 1_000_000.0), (7.0, "µg", 7.0 / 1000.0),
])
def test_to_mg_reference_cases(spark, value, unit, expected):
    df = spark.createDataFrame([(value, unit)], "v double, u string")
    got = df.select(fx.to_mg("v", "u")).first()[0]
    assert got == expected


def test_numeric_text(spark):
    values = ["1.5", " 2 ", ".5", "5.", "-0", "1e3", "", "n/a", "1.0d", "1_000", "nan", "1e400",
              "inf", "-Infinity", None]
    got = evaluate(spark, values, fx.numeric_text)
    exp = [1.5, 2.0, 0.5, 5.0, -0.0, 1000.0, None, None, None, None, None, None,
           math.inf, -math.inf, None]
    assert got == exp


def test_resolve_unit(spark):
    df = spark.createDataFrame(
        [("258682000", "x"), ("", "g"), ("", ""), ("999", "mg"), ("258676002", ""), ("", "258717005")],
        "c string, t string")
    got = [r[0] for r in df.select(fx.resolve_unit("c", "t")).collect()]
    assert got == ["g", "g", "", "999", "microgram", "ng"]


def test_default_unit(spark):
    assert evaluate(spark, ["", None, "g"], fx.default_unit) == ["mg", "mg", "g"]


def test_atc_levels_and_flags(spark):
    vals = ["J01CA04", "", None, "N"]
    assert evaluate(spark, vals, lambda c: fx.atc_level(c, 1)) == ["J", "", None, "N"]
    assert evaluate(spark, vals, lambda c: fx.atc_level(c, 4)) == ["J01CA", "", None, "N"]
    assert evaluate(spark, vals, fx.has_code) == [True, False, False, True]


# FIXED VALUES: inputs and results that must stay exactly as written.
def test_antibiotic_flag_reference_rows(spark):
    df = spark.createDataFrame(
        [("1", "J01CA04", "050101"), ("2", None, "050102"), ("3", "N02BE01", "040701"), ("4", None, None)],
        "vpid string, atc_code string, bnf_code string")
    got = df.orderBy("vpid").select(fx.antibiotic_by_any("atc_code", "bnf_code")).collect()
    assert [r[0] for r in got] == [True, True, False, False]
    only_atc = df.orderBy("vpid").select(fx.antibiotic_by_atc("atc_code")).collect()
    assert [r[0] for r in only_atc] == [True, None, False, None]


def test_mapping_status_levels(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, True), (False, False)],
                               "a boolean, b boolean")
    four = [r[0] for r in df.select(fx.mapping_status("a", "b", 4)).collect()]
    three = [r[0] for r in df.select(fx.mapping_status("a", "b", 3)).collect()]
    assert four == ["ATC + BNF", "ATC only", "BNF only", "Unmapped"]
    assert three == ["ATC + BNF", None, "BNF only", "Unmapped"]


def test_labels_other_and_code(spark):
    vals = ["J", "Q", "", None]
    assert evaluate(spark, vals, lambda c: fx.atc_group(c, "other")) == [
        "Anti-Infectives (Systemic)", "Other (Q)", "Other ()", "Other (NA)"]
    assert evaluate(spark, vals, lambda c: fx.atc_group(c, "code")) == [
        "Anti-Infectives (Systemic)", "Q", "", None]
    assert evaluate(spark, ["J01C", "J01Z"], lambda c: fx.j01_class(c, "other")) == [
        "Beta-lactam Penicillins", "Other (J01Z)"]


def test_percent_rounds_half_even(spark):
    vals = [0.0625, 0.0635, 2 / 3, 1.0, 0.0]
    assert evaluate(spark, vals, lambda c: fx.percent(c, 1), "double") == ["6.2%", "6.4%", "66.7%", "100.0%", "0.0%"]
    assert evaluate(spark, [0.125, 0.135, 0.5], lambda c: fx.percent(c, 0), "double") == ["12%", "14%", "50%"]
    assert evaluate(spark, [1234567, 12], fx.comma, "long") == ["1,234,567", "12"]

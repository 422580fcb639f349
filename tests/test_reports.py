"""Reports and the dose explorer on the fixture spine."""

import pytest

from rxcover import operators as op
from rxcover.operators.spine import SPINE_COLUMNS
from rxcover.sources.xml import read_classifications_xml, read_products_xml
from tests import fixtures as fx


@pytest.fixture()
def prepared(spark, tmp_path):
    item24, item25 = fx.release(tmp_path)
    spine = op.build_spine(read_products_xml(spark, item24),
                           read_classifications_xml(spark, item25, row_tags=("VMP", "REC")))
    return op.prepare(spine)


def test_coverage_in_level_order(prepared):
    got = [(r["mapping_status"], r["n"], r["pct"]) for r in op.coverage(prepared).collect()]
    assert got == [("ATC + BNF", 2, 2 / 6), ("ATC only", 2, 2 / 6), ("BNF only", 1, 1 / 6), ("Unmapped", 1, 1 / 6)]


def test_coverage_labels(prepared):
    labels = [r["label"] for r in op.coverage_labels(prepared).collect()]
    assert labels == ["2\n(33.3%)", "2\n(33.3%)", "1\n(16.7%)", "1\n(16.7%)"]


def test_three_way_status_leaves_atc_only_null(prepared, spark):
    three = op.prepare(prepared.select(*SPINE_COLUMNS), levels=3)
    got = sorted((r["mapping_status"] or "", r["n"]) for r in op.coverage(three, levels=3).collect())
    assert got == [("", 2), ("ATC + BNF", 2), ("BNF only", 1), ("Unmapped", 1)]


def test_group_filter(prepared):
    anti = {r["mapping_status"]: r["n"] for r in op.coverage(prepared, group="Anti-Infectives (Systemic)").collect()}
    assert anti == {"ATC + BNF": 1, "ATC only": 1}
    assert op.coverage(prepared, group="Not a group").count() == 0
    assert sum(r["n"] for r in op.coverage(prepared, group="All").collect()) == 6


def test_group_coverage_and_gap_rate(prepared):
    got = sorted((r["atc_group"], r["mapping_status"], r["n"], r["group_total"], r["pct"])
                 for r in op.group_coverage(prepared).collect())
    assert got == [
        ("Anti-Infectives (Systemic)", "ATC + BNF", 1, 2, 0.5),
        ("Anti-Infectives (Systemic)", "ATC only", 1, 2, 0.5),
        ("Nervous System", "ATC + BNF", 1, 2, 0.5),
        ("Nervous System", "ATC only", 1, 2, 0.5),
    ]
    assert op.group_gap_rate(prepared).count() == 0  # every group is under 20 rows
    rates = [(r["atc_group"], r["total"], r["unmapped"]) for r in op.group_gap_rate(prepared, min_size=1).collect()]
    assert sorted(rates) == [("Anti-Infectives (Systemic)", 2, 0), ("Nervous System", 2, 0)]


def test_antibiotic_reports(prepared):
    abx = op.antibiotics(prepared)
    assert sorted(r["vpid"] for r in abx.collect()) == ["111", "222", "333"]
    classes = sorted((r["j01_class"], r["total"]) for r in op.abx_subclass_total(abx).collect())
    assert classes == [("Beta-lactam Penicillins", 2), ("Other ()", 1)]
    level4 = [(r["atc_level4_code"], r["n"], r["j01_class"]) for r in op.abx_level4(abx).collect()]
    assert sorted(level4) == [("J01CA", 1, "Beta-lactam Penicillins"), ("J01CR", 1, "Beta-lactam Penicillins")]
    ddd = {r["j01_class"]: (r["total"], r["with_ddd"]) for r in op.abx_ddd(abx).collect()}
    assert ddd == {"Beta-lactam Penicillins": (2, 2), "Other ()": (1, 1)}
    gap = {r["status"]: r["n"] for r in op.abx_gap(abx).collect()}
    assert gap == {"Mapped to ATC": 2, "Missing ATC": 1}
    long = [(r["status"], r["n"], r["total"]) for r in op.abx_status_long(abx).collect()]
    assert long == [("ATC + BNF", 1, 3), ("BNF only", 1, 3), ("Unmapped", 0, 3)]
    missing = op.abx_missing(abx)
    assert missing.columns[0] == "Virtual Product ID (VPID)"
    assert [tuple(r) for r in missing.collect()] == [("333", "Piperacillin / Tazobactam 4g", "050101", "BNF only")]


def test_summary(prepared):
    r = op.summary(prepared).first()
    assert (r["total"], r["with_bnf"], r["with_atc"], r["antibiotics"]) == (6, 3, 4, 3)
    assert r["pct_bnf"] == 3 / 6 * 100


def test_ddd_lookup_order_and_names(prepared, spark):
    look = op.ddd_lookup(prepared)
    got = [(r["atc_code"], r["ddd"], r["drug_names"]) for r in look.collect()]
    assert got == [("", 14.0, "Piperacillin / Tazobactam 4g"), ("J01CA04", 1.5, "Amoxicillin"),
                   ("J01CR02", 3.0, "Co-amoxiclav 250mg"), ("N02BE01", 3.0, "Paracetamol")]
    rows = spark.createDataFrame(
        [("b", None, 1.0, "mg", 1.0), ("a", None, 1.0, "mg", 1.0), ("", None, 1.0, "mg", 1.0),
         ("", "X", 2.0, "g", 2000.0), ("c", "A", 2.0, "g", 2000.0)],
        "vmp_nm string, atc_code string, ddd double, ddd_uom string, ddd_mg double")
    got = [(r["atc_code"], r["drug_names"]) for r in op.ddd_lookup(rows).collect()]
    assert got == [("A", "c"), ("X", ""), (None, "a | b")]


def test_ddd_lookup_optional_columns(prepared):
    slim = prepared.select("vmp_nm", "atc_code", "ddd")
    assert op.ddd_lookup(slim).columns == ["atc_code", "ddd", "drug_names"]


def test_search_and_page(prepared):
    look = op.ddd_lookup(prepared)
    assert [r["atc_code"] for r in op.ddd_search(look, "AMOXI").collect()] == ["J01CA04", "J01CR02"]
    assert [r["atc_code"] for r in op.ddd_search(look, "amoxi co-").collect()] == ["J01CR02"]
    # per-column terms are case-insensitive substrings: "G" is found in "g" and "mg"
    assert [r["atc_code"] for r in op.ddd_search(look, column_terms={"ddd_uom": "G"}).collect()] == [
        "", "J01CA04", "J01CR02", "N02BE01"]
    assert [r["atc_code"] for r in op.ddd_search(look, column_terms={"ddd_uom": "MG", "atc_code": "j01"}).collect()] == [
        "J01CR02"]
    from pyspark.sql import functions as F
    order = [F.col(c).asc_nulls_last() for c in ("atc_code", "ddd", "ddd_uom", "ddd_mg")]
    assert [r["atc_code"] for r in op.page(look, 2, 3, order).collect()] == ["N02BE01"]
    assert [r["atc_code"] for r in op.page(look, 1, 3, order).collect()] == ["", "J01CA04", "J01CR02"]


def test_ddd_lookup_names_binary_order(spark):
    rows = spark.createDataFrame(
        [("alpha", "A", 1.0, "mg", 1.0), ("Zeta", "A", 1.0, "mg", 1.0), ("Éclair", "A", 1.0, "mg", 1.0),
         ("alpha", "A", 1.0, "mg", 1.0), ("beta", "A", 1.0, "mg", 1.0)],
        "vmp_nm string, atc_code string, ddd double, ddd_uom string, ddd_mg double")
    assert op.ddd_lookup(rows).first()["drug_names"] == "Zeta | alpha | beta | Éclair"


def test_search_matches_numbers_as_shown(prepared):
    look = op.ddd_lookup(prepared)
    assert [r["atc_code"] for r in op.ddd_search(look, "1500").collect()] == ["J01CA04"]
    assert op.ddd_search(look, "1500.0").count() == 0  # shown as 1500
    assert [r["atc_code"] for r in op.ddd_search(look, column_terms={"ddd": "1.5"}).collect()] == ["J01CA04"]

"""The spine build against an independent Python model of its semantics,
on generated record sets (fan-out, unmatched products, text doses, empty
units, fallback names, empty versus missing ATC)."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rxcover import codes
from rxcover.operators import build_spine
from tests.test_properties import model_mg, model_number

NAMES = ["Co-Amoxiclav 500mg", "co-fluampicil x", "PIPERACILLIN / TAZOBACTAM", "Paracetamol", "", "Aspirin co-amoxiclav"]
DOSES = ["", "n/a", "1.5", "3", " 2 ", "1e400", "inf", "0"]
UNITS = ["", "g", "mg", "microgram", "mL", "kg", "µg", " G "]
ATCS = ["", "J01CA04", "N02BE01", "J01X"]

keys = st.sampled_from([str(i) for i in range(8)])
product = st.tuples(st.sampled_from(NAMES), st.sampled_from(["", "9"]))
record = st.tuples(keys, st.sampled_from(["", "050101", "040701"]), st.sampled_from(ATCS),
                   st.sampled_from(DOSES), st.sampled_from(UNITS))


def model(vmp, bnf, unit_first=False):
    by = defaultdict(list)
    for r in bnf:
        by[r[0]].append(r)
    out = []
    for vpid, name, vtmid, prev in vmp:
        for m in by.get(vpid) or [None]:
            bnf_code, atc, ddd, uom = (None, None, None, None) if m is None else (m[1], m[2], model_number(m[3]), m[4])
            if not unit_first:
                uom = "mg" if not uom else uom
            for frag, r_ddd, r_unit, r_atc in codes.FALLBACK_RULES:
                if ddd is None and frag in name.lower():
                    ddd = r_ddd
                    atc = r_atc if atc is None else atc
                    uom = r_unit if not uom else uom
                    break
            uom = "mg" if not uom else uom
            out.append((vpid, name, vtmid, prev, bnf_code, atc, ddd, uom, model_mg(ddd, uom)))
    return out


def norm(rows):
    return sorted(tuple("<null>" if v is None else repr(v) for v in r) for r in rows)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(products=st.dictionaries(keys, product, min_size=1, max_size=6),
       records=st.lists(record, max_size=25))
def test_spine_matches_model(spark, products, records):
    vmp = [(k, n, t, "") for k, (n, t) in products.items()]
    bnf = [(k, b, a, d, u.strip()) for k, b, a, d, u in records]
    vdf = spark.createDataFrame(vmp, "vpid string, vmp_nm string, vtmid string, vpid_prev string")
    bdf = spark.createDataFrame(bnf, "vpid string, bnf_code string, atc_code string, ddd string, ddd_uom string")
    for unit_first in (False, True):
        got = [tuple(r) for r in build_spine(vdf, bdf, fallback_unit_first=unit_first).collect()]
        assert norm(got) == norm(model(vmp, bnf, unit_first)), unit_first

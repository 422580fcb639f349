"""Property tests: column expressions against small Python models of the
same semantics, on batches of generated values (one Spark job per batch)."""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rxcover import codes
from rxcover import functions as fx
from rxcover.functions.text import WHITESPACE

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

ws = st.sampled_from(list(WHITESPACE))
word = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12)
padded = st.tuples(st.lists(ws, max_size=3), word, st.lists(ws, max_size=3)).map(
    lambda t: "".join(t[0]) + t[1] + "".join(t[2]))


def run(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


@SETTINGS
@given(values=st.lists(st.one_of(padded, st.none()), min_size=1, max_size=200))
def test_trim_text_is_python_strip(spark, values):
    assert run(spark, values, fx.trim_text) == [None if v is None else v.strip() for v in values]


@SETTINGS
@given(values=st.lists(st.text(alphabet="ab{}:/ ", max_size=10), min_size=1, max_size=200))
def test_strip_namespace_is_last_part(spark, values):
    assert run(spark, values, fx.strip_namespace) == [v.split("}")[-1] for v in values]


_NUM = re.compile(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")


def model_number(s):
    if s is None:
        return None
    t = s.strip()
    if _NUM.match(t):
        v = float(t)
        return None if math.isinf(v) else v
    low = t.lower()
    if low in ("inf", "+inf", "infinity", "+infinity"):
        return math.inf
    if low in ("-inf", "-infinity"):
        return -math.inf
    return None


number_text = st.one_of(
    st.floats(allow_nan=False, allow_infinity=False).map(repr),
    st.integers(-10**6, 10**6).map(str),
    st.sampled_from(["", "n/a", "1.0d", "1_000", "nan", "1e400", "-1e400", "inf", "-Infinity", ".5", "5.",
                     " 7 ", "+3", "1e-5", "0x10", "--1"]),
)


@SETTINGS
@given(values=st.lists(st.one_of(number_text, st.none()), min_size=1, max_size=200))
def test_numeric_text_model(spark, values):
    got = run(spark, values, fx.numeric_text)
    assert got == [model_number(v) for v in values]


def model_mg(v, u):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    conv = codes.MG_CONVERSIONS.get(str(u).strip().lower())
    if conv is None:
        return None
    op, factor = conv
    return v * factor if op == "*" else v / factor


units = st.one_of(st.sampled_from(list(codes.MG_CONVERSIONS) + ["MG", " G ", "Kg", "mL", "MU", "", "unit", "µG"]),
                  st.none())


@SETTINGS
@given(pairs=st.lists(st.tuples(st.one_of(st.floats(allow_nan=True, allow_infinity=False, width=64), st.none()),
                                 units), min_size=1, max_size=200))
def test_to_mg_model(spark, pairs):
    df = spark.createDataFrame([(i, v, u) for i, (v, u) in enumerate(pairs)], "i int, v double, u string")
    got = [r[0] for r in df.orderBy("i").select(fx.to_mg("v", "u")).collect()]
    exp = [model_mg(v, u) for v, u in pairs]
    assert [None if g is None else repr(g) for g in got] == [None if e is None else repr(e) for e in exp]


@SETTINGS
@given(pairs=st.lists(st.tuples(st.sampled_from(list(codes.UNIT_CODES) + ["", "123", " 258682000 "]),
                                 st.sampled_from(["", "g", "mg", "x"])), min_size=1, max_size=100))
def test_resolve_unit_model(spark, pairs):
    df = spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(pairs)], "i int, c string, t string")
    got = [r[0] for r in df.orderBy("i").select(fx.resolve_unit("c", "t")).collect()]
    exp = []
    for c, t in pairs:
        raw = c or t
        exp.append(codes.UNIT_CODES.get(raw, raw))
    assert got == exp

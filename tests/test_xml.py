"""XML sources: record shape, first child, key rules, namespaces, guards."""

import re
import xml.etree.ElementTree as ET

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from rxcover.sources import xml_blocks
from rxcover.sources.xml import NoRecordsError, read_classifications_xml, read_products_xml
from tests import fixtures as fx


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_products(spark, tmp_path):
    item24, _ = fx.release(tmp_path)
    vmp = read_products_xml(spark, item24)
    assert vmp.columns == ["vpid", "vmp_nm", "vtmid", "vpid_prev"]
    got = rows(vmp, "vpid", "vmp_nm", "vtmid", "vpid_prev")
    assert got == [
        ("", "No key", "", ""),
        ("111", "Co-amoxiclav 250mg", "", ""),
        ("222", "Amoxicillin", "9", "221"),
        ("333", "Piperacillin / Tazobactam 4g", "", ""),
        ("444", "Paracetamol", "", ""),  # first NM wins
    ]


def test_classifications_two_tags(spark, tmp_path):
    _, item25 = fx.release(tmp_path)
    bnf = read_classifications_xml(spark, item25, row_tags=("VMP", "REC"))
    assert bnf.columns == ["vpid", "bnf_code", "atc_code", "ddd", "ddd_uom"]
    got = rows(bnf, "vpid", "bnf_code", "atc_code", "ddd", "ddd_uom")
    assert got == [
        ("222", "050101", "J01CA04", "1.5", "g"),
        ("333", "050101", "", "", "g"),
        ("444", "", "N02BE01", "n/a", ""),
        ("444", "040701", "N02BE01", "3", "mg"),
        ("999", "", "A01AA01", "", ""),
    ]


def test_classifications_of_any_element(spark, tmp_path):
    _, item25 = fx.release(tmp_path)
    assert read_classifications_xml(spark, item25).count() == 5
    assert read_classifications_xml(spark, item25, row_tags=("VMP",)).count() == 4


def test_records_of_any_element_at_any_depth(spark, tmp_path):
    fx.write(tmp_path, "k/f_bnf1.xml", """<?xml version="1.0"?><R xmlns:p="urn:p">
      <A><ATC>x</ATC><N a="1"/><VPID>1</VPID></A><!-- <C><VPID>9</VPID></C> --><p:B id="2>1"><p:VPID>2</p:VPID></p:B>
      <D><VPID/></D><E><VPID k="1">3</VPID><VPID>4</VPID><F><G><VPID>5</VPID></G></F></E><VPIDPREV>7</VPIDPREV></R>""")
    assert rows(read_classifications_xml(spark, str(tmp_path / "k")), "vpid", "atc_code") == [("1", "x"), ("2", ""), ("3", ""), ("5", "")]


def test_outer_key_after_an_inner_record(spark, tmp_path):
    fx.write(tmp_path, "o/f_bnf1.xml", "<R><OUTER><INNER><VPID>1</VPID><ATC>i</ATC></INNER><VPID>2</VPID><ATC>o</ATC></OUTER></R>")
    assert rows(read_classifications_xml(spark, str(tmp_path / "o")), "vpid", "atc_code") == [("1", "i"), ("2", "o")]


def test_nested_products(spark, tmp_path):
    fx.write(tmp_path, "v/f_vmp2.xml", "<R><VMP><VPID>1</VPID><VMP><VPID>2</VPID></VMP><NM>a</NM></VMP><VMP/><VMP>x</VMP></R>")
    assert rows(read_products_xml(spark, str(tmp_path / "v")), "vpid", "vmp_nm") == [("", ""), ("", ""), ("1", "a"), ("2", "")]


def test_text_before_the_first_inner_element(spark, tmp_path):
    fx.write(tmp_path, "m/f_vmp2.xml", "<R><VMP><VPID>1</VPID><NM>a &lt;&#65;&#x42;<!-- c --> z<![CDATA[ <&> ]]>y <i>b</i> c</NM><VTMID><b/>t</VTMID></VMP></R>")
    assert rows(read_products_xml(spark, str(tmp_path / "m")), "vpid", "vmp_nm", "vtmid") == [("1", "a <AB z <&> y", "")]


class small_blocks:
    def __init__(self, spark, size):
        self.spark, self.size = spark, {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}

    def __enter__(self):
        for k, v in self.size.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *_):
        for k in self.size:
            self.spark.conf.unset(k)


def test_blocks_of_a_file(spark, tmp_path):
    """Elements, comments, CDATA and texts with '>' over block edges."""
    body = "".join(f"<G{i % 3}><VPID>{i}</VPID><!-- > <VPID>no</VPID> > --><ATC>A > {i}<![CDATA[ ]>> </ATC> > ]]></ATC>"
                   f"<IN><VPID>i{i}</VPID></IN></G{i % 3}>\n" for i in range(40))
    fx.write(tmp_path, "s/f_bnf1.xml", f"<R><OUT><IN><VPID>first</VPID></IN>{body}<VPID>outer</VPID></OUT></R>\n")
    want = sorted([("first", ""), ("outer", ""), *[(f"i{i}", "") for i in range(40)], *[(str(i), f"A > {i} ]>> </ATC> >") for i in range(40)]])
    for size in (1 << 20, 700, 150):
        with small_blocks(spark, size):
            assert rows(read_classifications_xml(spark, str(tmp_path / "s")), "vpid", "atc_code") == want


def test_large_file_is_read_by_many_tasks(spark, tmp_path):
    body = "".join(f"<{'REC' if i == 55_000 else 'VMP'}><VPID>{i}</VPID><ATC>A{i}</ATC></{'REC' if i == 55_000 else 'VMP'}>\n" for i in range(60_000))
    fx.write(tmp_path, "l/f_bnf1.xml", f"<ROOT>{body}</ROOT>")
    with small_blocks(spark, 1 << 18):
        parts = xml_blocks._blocks(spark, str(tmp_path / "l"), "f_bnf*.xml")
        assert parts.rdd.getNumPartitions() > 8
        plan = xml_blocks._parsed(parts, ["VPID"], lambda *_: False, {})._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan text") == 1
        assert read_classifications_xml(spark, str(tmp_path / "l")).count() == 60_000


MALFORMED = ["<R><A>1</B></R>", "<R><A>", "<R/><R/>", "<R></R>x", "x<R></R>", "<R><VMP><VPID>1 &nope; 2</VPID></VMP></R>", "<R><A b=c></A></R>",
             "<R><A <B></B></R>", "</R>", "<R></R></R>", "<R><!-- x </R>", "<R>", "", "x", "<R></R", "<R><VMP><VPID>2 & 3</VPID></VMP></R>",
             '<?xml version="1.0" encoding="utf-16"?><R><VMP><VPID>1</VPID></VMP></R>']


@pytest.mark.parametrize("text", MALFORMED)
def test_malformed_markup(text):
    with pytest.raises(ValueError):
        parse_blocks([text.encode()], lambda name, _: name == "VMP")


TAGS = ("VPID", "ATC", "NM")


def parse_blocks(parts, rule):
    """Parts as the job reads them: each begins with '</', a rest is put before the next."""
    edges, out, rest = [], [], b""
    for k, part in enumerate(parts):
        block = xml_blocks.Block(frozenset(TAGS), rule, rest)
        for i in range(0, len(part), 37):       # pieces of any size come in
            out += block.feed(part[i:i + 37])
        out += block.feed(b"", last=True)
        rest = block.rest
        edges.append({"block": k, "edge": block.edge(), "rest": rest if k == len(parts) - 1 else b""})
    return out + xml_blocks.fold(pd.DataFrame(edges), frozenset(TAGS), rule)


names = st.sampled_from(["A", "p:B", "VPID", "ATC", "NM", "VMP", "p:VPID"])
texts = st.sampled_from(["", " ", "1", "x > y", "&amp;&#62;", "\r\n", "é", "<![CDATA[<VPID>c</VPID>]]>", "<!-- <VPID> > -->", "<?p > ?>"])
elements = st.recursive(st.tuples(names, texts), lambda inner: st.tuples(names, texts, st.lists(st.tuples(inner, texts), max_size=4)), max_leaves=25)


def markup(e):
    inner = "".join(markup(c) + t for c, t in e[2]) if len(e) > 2 else ""
    head = f'{e[0]} a="1 > 2"' if len(e[1]) % 2 else e[0]
    return f"<{head}/>" if not e[1] and not inner else f"<{head}>{e[1]}{inner}</{e[0]}>"


@settings(max_examples=400, deadline=None)
@given(elements, st.randoms())
def test_blocks_equal_a_whole_parse(e, rng):
    text = f'<R xmlns:p="urn:p">{markup(e)}</R>'
    by_name = lambda tag: tag.rpartition("}")[2].rpartition(":")[2]
    for rule in (lambda name, kids: bool(kids.get("VPID")), lambda name, _: name == "VMP"):
        want = []
        for el in ET.fromstring(text).iter():
            kids = {}
            for c in el:
                if by_name(c.tag) in TAGS:
                    kids.setdefault(by_name(c.tag), c.text or "")
            if rule(by_name(el.tag), kids):
                want.append(kids)
        ends = [m.start() for m in re.finditer("</", text)]
        cuts = sorted(set(rng.sample(ends, min(len(ends), 4))) | {0, len(text)})
        got = parse_blocks([text[a:b].encode() for a, b in zip(cuts, cuts[1:])], rule)
        assert sorted(map(repr, map(sorted, (g.items() for g in got)))) == sorted(map(repr, map(sorted, (w.items() for w in want))))


def test_namespaced_records_are_read(spark, tmp_path):
    fx.write(tmp_path, "ns/deep/er/f_vmp2_ns.xml", fx.NAMESPACED_VMP)
    got = rows(read_products_xml(spark, str(tmp_path / "ns")), "vpid", "vmp_nm")
    assert got == [("1", "a"), ("2", "b")]


def test_blank_key_kept_empty_key_skipped(spark, tmp_path):
    fx.write(tmp_path, "b/f_bnf9.xml", fx.BLANK_KEY_BNF)
    got = rows(read_classifications_xml(spark, str(tmp_path / "b")), "vpid", "atc_code")
    assert got == [("", "Y")]


def test_nested_records_of_different_tags(spark, tmp_path):
    fx.write(tmp_path, "n/f_bnf_n.xml", fx.NESTED_BNF)
    got = rows(read_classifications_xml(spark, str(tmp_path / "n"), row_tags=("VMP", "REC")), "vpid", "atc_code")
    assert got == [("1", "A"), ("2", "B")]


def test_no_matching_file_raises(spark, tmp_path):
    fx.write(tmp_path, "e/other.xml", fx.VMP_XML)
    with pytest.raises(NoRecordsError):
        read_products_xml(spark, str(tmp_path / "e"))


def test_file_without_records_raises(spark, tmp_path):
    fx.write(tmp_path, "z/f_vmp2_empty.xml", fx.NO_RECORD)
    with pytest.raises(NoRecordsError):
        read_products_xml(spark, str(tmp_path / "z"))


def test_malformed_file_fails(spark, tmp_path):
    fx.write(tmp_path, "t/f_vmp2_t.xml", fx.TRUNCATED)
    with pytest.raises((PySparkException, Py4JJavaError, NoRecordsError)):
        read_products_xml(spark, str(tmp_path / "t")).collect()

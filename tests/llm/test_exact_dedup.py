import hashlib
import re

from rxcover.llm import exact_dedup as xd

ROWS = [(5, "a b"), (3, "ab"), (4, "a  b"), (9, None), (8, ""), (7, " \t\n"), (None, "q"), (2, "q"), (6, "x" * 50000),
        (1, "q "), (1, "q "), (10, "a b")]


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for k, v in groups.items():
        keep = min(v)[3]
        done = False
        for _, _, _, i in sorted(v):
            out.append((i, keep, len(v), not done, hashlib.sha256(k.encode()).hexdigest()))
            done = True
    return sorted(out, key=repr)


def test_against_brute_force(spark, make_docs):
    got = xd.exact_dedup(spark, make_docs(ROWS, extra=("kept", "text_sha256", "rid", "w")))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(ROWS)


def test_second_batch_meets_the_index(spark, make_docs):
    index = xd.new_index(spark, buckets=4)
    xd.dedup_batch(spark, make_docs([(1, "one"), (2, "two")]), index, 4).collect()
    got = {r.doc_id: r for r in xd.dedup_batch(spark, make_docs([(3, "o ne"), (4, "three")]), index, 4).collect()}
    assert (got[3].keep_id, got[3].kept, got[4].keep_id, got[4].kept) == (1, False, 4, True)
    assert spark.table(index).count() == 3
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {index}").collect()}
    assert info["Num Buckets"] == "4" and "text_sha256" in info["Sort Columns"]


def test_batch_run_again_gets_the_same_decisions(spark, make_docs):
    """The driver is lost after the append: the batch runs again by its id."""
    index = xd.new_index(spark, buckets=4)
    xd.dedup_batch(spark, make_docs([(1, "one")]), index, 4, batch="a").collect()
    rows = make_docs([(3, "o ne"), (4, "three"), (5, "t hree"), (4, "three"), (6, "six")])
    first = sorted(tuple(r) for r in xd.dedup_batch(spark, rows, index, 4, batch="b").collect())
    assert [r[3] for r in first].count(True) == 2
    assert sorted(tuple(r) for r in xd.dedup_batch(spark, rows, index, 4, batch="b").collect()) == first
    assert spark.table(index).count() == 3
    assert not any(r.kept for r in xd.dedup_batch(spark, rows, index, 4, batch="c").collect())


def test_batch_cut_short_appends_the_rest(spark, make_docs):
    index = xd.new_index(spark, buckets=4)
    part = make_docs([(4, "three")])
    xd.dedup_batch(spark, part, index, 4, batch="b").collect()
    got = {r.doc_id: r.kept for r in xd.dedup_batch(spark, make_docs([(4, "three"), (6, "six"), (7, "s ix")]), index, 4, batch="b").collect()}
    assert got == {4: True, 6: False, 7: True} and spark.table(index).count() == 2


def test_index_of_one_call_goes(spark, make_docs):
    tables = lambda: {r.tableName for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith("digest_index")}
    before = tables()
    out = xd.exact_dedup(spark, make_docs(ROWS))
    assert tables() == before and out.count() == len(ROWS)
    index = xd.new_index(spark, buckets=4)
    assert tables() - before == {index}
    xd.drop_index(spark, index)
    assert tables() == before


def test_empty_and_pipeline_rows(spark, make_docs):
    assert xd.exact_dedup(spark, make_docs([])).count() == 0
    kept = xd.keep_first_copies(spark, make_docs(ROWS, extra=("kept", "__keep_id", "__sha")))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept", "__keep_id", "__sha"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 6, 7, 10]

"""Queries read whole tables."""

import pytest

from paperloom.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["IMAGES", "DETECTIONS", "SUBFORMULAS", "SCORES", "NEWER"])
def test_all_lines_reach_the_operators(spark, name):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_linenumber").distinct().count()
    assert registry.source(spark, SF, getattr(registry, name)).count() == lines


def test_all_keys_are_made_unique(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_linenumber").distinct().count()
    assert registry.QUERIES["x_bibkey_dedup"](spark, SF).count() == lines


def test_all_of_a_text_is_read(spark, tmp_path):
    docs = spark.createDataFrame([(1, "x " * 200 + "Graphene formulación", "s"), (3, "a" * 30 + "b" * 30 + "c" * 30 + "d" * 30, "s")], "doc_id long, text string, source string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.hits for r in registry.QUERIES["m_classify"](spark, str(tmp_path)).collect()}
    assert got == {1: 1, 3: 0}
    spans = {(r.doc_id, r.pos): r.md_start for r in registry.QUERIES["f_locate_spans"](spark, str(tmp_path)).collect()}
    assert [spans[3, k] for k in range(4)] == [0, 30, 60, None]


def test_lines_are_dealt_by_the_size_of_their_table(spark):
    """Not into the session's number of partitions, whose size grows with the input; groups by order need no shuffle more."""
    from paperloom.plans import registry as r

    d = r.source(spark, "/root/testdata/sf0.001", "SELECT l_orderkey, l_linenumber, l_partkey FROM __LI__")
    assert d.rdd.getNumPartitions() >= r.PARTS_A_SCAN
    assert d._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1

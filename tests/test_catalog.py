"""All registered queries against their SQL, and the shape of their plans."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from weftline.plans.catalog import ORACLES as CATALOG_SQL
from weftline.plans.catalog import QUERIES as CATALOG
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
SQL = oracle_sql()
QUERIES = queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2" if "stream" in name else before)  # few keys of state need few tasks
    try:
        compare(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def compare(spark, duck, name):
    assert difference(spark, duck, SF_DIR, QUERIES[name], SQL[name]) is None


def test_every_query_has_sql():
    assert set(CATALOG_SQL) == set(CATALOG)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["user_id", "ts", "s_value", "t_value"]
    assert df.count() > 0


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


JOINS = [n for n in QUERIES if re.match(r"j[1-9]", n) and not n.endswith("stream")]


@pytest.mark.parametrize("name", JOINS)
def test_join_plans(spark, name):
    text = plan(QUERIES[name](spark, "/root/testdata/sf0.01"))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if not name.startswith(("j6", "j8")):
        assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize("name", ["j1_fuzzy_merge_join", "j3_bufferless_newest_join", "j5_bufferless_oldest_join"])
def test_one_shuffle_by_key(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "SinglePartition" not in text


def test_sliced_stream_reuses_its_shuffle(spark):
    text = plan(QUERIES["j1_fuzzy_merge_join_unkeyed"](spark, "/root/testdata/sf0.01"))
    assert "ReusedExchange" in text
    # rows are only ever shuffled by slice or label; the single partition holds one row per slice
    own = "\n".join(line for line in text.splitlines() if "ReusedExchange" not in line)
    shuffles = re.findall(r"Exchange (hashpartitioning\(\w+|SinglePartition)", own)
    assert sorted(re.sub(r"#.*", "", s) for s in shuffles) == [
        "SinglePartition", "hashpartitioning(_label", "hashpartitioning(_slice",
    ]


def test_scan_reads_only_what_is_needed(spark):
    text = plan(QUERIES["w1_tumbling_unkeyed"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in text.replace("\n", "")
    assert "user_id" not in text and "props" not in text

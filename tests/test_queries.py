"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from compare import TABLES, compare, connect
from shelfwright.plans.registry import load_all

FOLDER = "/root/testdata/sf0.001"
REGISTRY = load_all()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, duck, name):
    verdict, _, _ = compare(spark, duck, name, REGISTRY[name], FOLDER)
    assert verdict.startswith(("ok", "rows-only")), verdict


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(REGISTRY) <= set(entry.oracle_sql())


# a third of the rows of each table share one key, or are copies of one text
SKEW = {
    "lineitem": "UPDATE lineitem SET l_orderkey = 77, l_partkey = 5, l_suppkey = 3 WHERE hash(l_extendedprice) % 3 = 0",
    "orders": "UPDATE orders SET o_custkey = 42 WHERE hash(o_orderkey) % 3 = 0",
    "events": "UPDATE events SET user_id = 7 WHERE hash(event_id) % 3 = 0",
    "documents": "UPDATE documents SET source = 'src1', lang = 'en', "
    "text = (SELECT text FROM documents WHERE doc_id = 1) WHERE hash(doc_id) % 3 = 0",
    "part": "UPDATE part SET p_name = 'red ring', p_type = 'ECONOMY', p_brand = 'Brand#2' WHERE hash(p_partkey) % 3 = 0",
    "pages": "UPDATE pages SET url = 'https://one.example.com/en/page.html' WHERE hash(page_id) % 3 = 0",
}
SKEWED = [
    "generated_keys", "duplicate_id_pairs", "id_stats", "child_replace", "cascade_delete", "dangling_composite",
    "nearest_term", "rule_format", "cache_latest", "cache_lookup", "link_health", "alias_normalise",
    "join_bridge_category", "option_list", "category_membership", "index_maintenance", "findings_tiered",
    "coverage_by_format", "rekey_mapping", "duplicate_in_list",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = connect(FOLDER)
    for name in TABLES:
        con.execute(f"CREATE TABLE copy_{name} AS SELECT * FROM {name}")
        if name in SKEW:
            con.execute(SKEW[name].replace(f"UPDATE {name}", f"UPDATE copy_{name}"))
        con.execute(f"COPY copy_{name} TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", SKEWED)
def test_skewed_query(spark, skewed, name):
    verdict, _, _ = compare(spark, connect(skewed), name, REGISTRY[name], skewed)
    assert verdict.startswith("ok"), verdict

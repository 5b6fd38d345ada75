"""Records of the order tables on hand-made rows: nulls, missing partners, ties and empty tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from alertloom.plans import order_queries
from alertloom.sources import tables

DAY = dt.datetime(1999, 1, 1)
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, l_discount double, "
    "l_tax double, l_shipdate timestamp_ntz",
}
ROWS = {
    "region": [(0, "ASIA")],
    "nation": [(1, "JAPAN", 0)],
    "customer": [(7, "a", 1, 1.5, "BUILDING"), (8, "b", None, None, None)],
    "part": [(1, "x", "B", "T", 10, 2.5), (2, "y", "B", "T", None, 1.25)],
    "orders": [
        (1, 7, "O", 10.0, DAY, "1-URGENT"),
        (2, 8, "F", 20.0, DAY, "5-LOW"),
        (3, 99, None, None, None, None),
        (4, 7, "O", 5.0, DAY, "4-NOT SPECIFIED"),
    ],
    "lineitem": [
        (1, 1, 2.0, 100.0, 0.1, 0.02, DAY + dt.timedelta(days=3)),
        (1, 1, 2.0, 100.0, 0.1, 0.02, DAY + dt.timedelta(days=3)),
        (1, 2, 1.0, 0.01, 0.0, 0.08, DAY + dt.timedelta(days=1)),
        (2, 55, 4.0, None, None, None, None),
        (3, 1, 1.0, 1.0, 0.0, 0.0, DAY),
    ],
}


def written(spark, folder, rows):
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(rows.get(name, []), schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    return written(spark, tmp_path_factory.mktemp("orders"), ROWS)


def test_sums_and_missing_partners(spark, small):
    got = {row.o_orderkey: row.asDict() for row in tables.order_records(spark, small).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    one, two, three, four = (got[k] for k in (1, 2, 3, 4))
    assert (one["n_lines"], one["quantity"], one["n_parts"], one["ship_days"]) == (3, 5.0, 3, 3)
    assert one["revenue"] == pytest.approx(180.01) and one["discount"] == pytest.approx(0.2 / 3)
    assert one["part_size"] == 10.0 and one["retail"] == 6.25 and one["r_name"] == "ASIA"
    # a line without its part and without numbers still counts as a line
    assert (two["n_lines"], two["n_parts"], two["quantity"]) == (1, 0, 4.0)
    assert all(two[c] is None for c in ("revenue", "discount", "tax", "part_size", "retail", "ship_days", "r_name", "c_acctbal"))
    # no customer, no day
    assert three["c_mktsegment"] is None and three["ship_days"] is None and three["n_lines"] == 1
    assert four["n_lines"] == 0 and four["quantity"] is None and four["n_parts"] is None


def test_profile_and_split_of_nulls(spark, small):
    nulls = {row.column: row.null_count for row in order_queries.order_null_profile(spark, small).collect()}
    assert nulls["o_orderpriority"] == 1 and nulls["revenue"] == 2 and "n_lines" not in nulls
    kept = order_queries.order_stratified_split(spark, small).collect()
    assert {row.o_orderkey for row in kept} == {1, 2}
    weights = {row.o_orderkey: row.class_weight for row in order_queries.order_attach_class_weight(spark, small).collect()}
    assert sorted(weights) == [1, 2, 3, 4] and weights[3] == weights[4] == 1.0


def test_empty_tables(spark, tmp_path):
    empty = written(spark, tmp_path / "none", {})
    assert tables.order_records(spark, empty).count() == 0
    for name in ("order_null_profile", "order_class_distribution", "order_class_shift", "order_categorical_profile"):
        assert order_queries.__dict__[name](spark, empty).count() == 0
    checks = order_queries.order_split_overlaps(spark, empty)
    assert checks.agg(F.sum("n")).first()[0] == 0


def test_a_key_may_hold_most_lines(spark, tmp_path):
    """Sums do not depend on how the lines of one order are dealt out."""
    lines = [(1, 1, 1.0, 0.1, 0.07, 0.03, DAY)] * 999
    folder = written(spark, tmp_path / "hot", {**ROWS, "lineitem": [*ROWS["lineitem"], *lines]})
    row = tables.order_records(spark, folder).filter("o_orderkey = 1").first()
    assert row.n_lines == 1002 and row.revenue == (999 * 10 * 93 + 1_800_100) / 10_000

"""All queries again, over star tables with missing and repeated keys, nulls and a hot customer."""

import pytest
from compare import TABLES, connect, differences
from helpers import TESTDATA

import __spark_entry__ as entry_points

SOURCE = f"{TESTDATA}/sf0.001"
SQL = entry_points.oracle_sql()

DIRTY = {
    "customer": """
        SELECT c_custkey, IF(c_custkey % 17 = 0, NULL, c_name) AS c_name,
          CAST(CASE WHEN c_custkey % 19 = 0 THEN 99 WHEN c_custkey % 23 = 0 THEN NULL ELSE c_nationkey END AS INT)
            AS c_nationkey, c_acctbal, c_mktsegment
        FROM customer WHERE c_custkey % 29 <> 0""",
    "part": """
        SELECT p_partkey, p_name, p_brand, CASE WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN NULL
          WHEN p_partkey % 5 = 0 THEN 'Photo/Solar' ELSE p_type END AS p_type, p_size, p_retailprice
        FROM part WHERE p_partkey % 31 <> 0""",
    "orders": """
        SELECT IF(o_orderkey % 97 = 0, NULL, o_orderkey) AS o_orderkey,
          CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey,
          CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 43 = 0 THEN 'X' ELSE o_orderstatus END
            AS o_orderstatus, o_totalprice,
          IF(o_orderkey % 47 = 0, NULL, o_orderdate) AS o_orderdate,
          IF(o_orderkey % 53 = 0, NULL, o_orderpriority) AS o_orderpriority
        FROM orders""",
    "lineitem": """
        SELECT IF(l_partkey % 101 = 0, NULL, l_orderkey) AS l_orderkey,
          IF(l_suppkey % 7 = 0, NULL, l_partkey) AS l_partkey, l_suppkey, l_linenumber,
          IF(l_partkey % 29 = 0, NULL, l_quantity) AS l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
          l_linestatus, IF(l_suppkey % 9 = 0, NULL, l_shipdate + INTERVAL '90' MINUTE * (l_partkey % 5)) AS l_shipdate
        FROM lineitem""",
}


@pytest.fixture(scope="module")
def dirty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("dirty"))
    for table in TABLES:
        spark.read.parquet(f"{SOURCE}/{table}.parquet").createOrReplaceTempView(table)
    for table in TABLES:
        df = spark.sql(DIRTY[table]) if table in DIRTY else spark.table(table)
        df.coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    for table in TABLES:
        spark.catalog.dropTempView(table)
    return folder


@pytest.fixture(scope="module")
def duck(dirty):
    return connect(dirty, "*.parquet")


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, dirty, duck, name):
    assert differences(entry_points.queries()[name](spark, dirty), duck, SQL[name]) is None

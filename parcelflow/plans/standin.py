"""Stand-in projections of the driver's TPC-H-like tables into the MLS schema.

Each SQL text is used verbatim by both engines: Spark binds the ``{table}``
placeholders to DataFrames read from ``sf_dir`` (``spark.sql(text, **dfs)``),
the DuckDB oracle binds them to its pre-registered views. The texts stay in
the common subset of Spark SQL and DuckDB (no ``//``; coordinates are built
by multiplying with decimal literals, never dividing, because DuckDB divides
decimals in double while Spark divides them exactly, and an ulp of
difference moves points across polygon edges).
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The sold stand-in: every defect the quality stage flags is seeded on purpose,
# prices and areas beyond all thresholds, low outliers, dates and numbers as text
# with values that are none, and columns outside the keep-list, one nearly all null.
SOLD_SQL = """
SELECT l_orderkey*10+l_linenumber AS ListingKey,
  CASE WHEN l_partkey%97=0 THEN -1.0*l_discount WHEN l_partkey%89=0 THEN NULL
       WHEN l_partkey%503=1 THEN 100000.0*l_extendedprice
       ELSE l_extendedprice*(1-l_discount)*(CASE WHEN l_partkey%37=0 THEN 5 ELSE 1 END) END AS ClosePrice,
  l_extendedprice AS ListPrice,
  CASE WHEN l_partkey%50=0 THEN 0.0 WHEN l_partkey%61=0 THEN NULL
       ELSE l_extendedprice*(1+l_tax-0.04) END AS OriginalListPrice,
  CAST(o_orderdate AS date) AS ListingContractDate,
  CASE WHEN l_suppkey%33=1 THEN NULL WHEN l_suppkey%33=3 THEN 'unknown'
       ELSE concat(CAST(CAST(o_orderdate AS date)+CAST(l_quantity AS int)
       -(CASE WHEN l_partkey%142=0 THEN 55 ELSE 0 END) AS varchar(10)),
       CASE WHEN l_suppkey%33=2 THEN 'T10:30:00' ELSE '' END) END AS PurchaseContractDate,
  CASE WHEN l_suppkey%47=2 THEN NULL ELSE CAST(o_orderdate AS date)+CAST(l_quantity AS int)
       +l_linenumber*7-(CASE WHEN l_partkey%71=0 THEN 130 ELSE 0 END) END AS CloseDate,
  CAST(l_quantity*l_linenumber AS int)-3 AS DaysOnMarket,
  CASE WHEN o_orderstatus='F' THEN 'Closed' WHEN o_orderstatus='O' THEN 'Active'
       ELSE 'Pending' END AS MlsStatus,
  CASE WHEN c_mktsegment IN ('BUILDING','HOUSEHOLD','FURNITURE') THEN 'Residential'
       ELSE c_mktsegment END AS PropertyType,
  p_type AS PropertySubType,
  CASE WHEN l_partkey%101=0 THEN 0.0 WHEN l_partkey%149=2 THEN 40.0 WHEN l_partkey%307=3 THEN 30000.0
       ELSE 1000+0.2*(l_extendedprice/(20.0+p_size)) END AS LivingArea,
  CASE WHEN c_custkey%211=0 THEN -1 ELSE l_linenumber END AS BedroomsTotal,
  CASE WHEN c_custkey%223=0 THEN '-1' WHEN l_partkey%113=4 THEN 'n/a' WHEN l_partkey%113=5 THEN '2d'
       ELSE CAST(1+l_linenumber%4 AS varchar(10)) END AS BathroomsTotalInteger,
  1842+p_size*4 AS YearBuilt,
  n_name AS CountyOrParish,
  concat('City_',CAST(c_custkey%60 AS varchar(10))) AS City,
  concat(CAST(90000+c_custkey%400 AS varchar(10)),'.0') AS PostalCode,
  r_name AS MLSAreaMajor,
  CAST(CASE WHEN s_suppkey%9=0 THEN NULL WHEN s_suppkey%41=2 THEN 0.0
       ELSE 32.3+(l_partkey%980)*0.01 END AS double) AS Latitude,
  CAST(CASE WHEN s_suppkey%23=3 THEN 118.0
       ELSE -124.6+(l_orderkey%1060)*0.01 END AS double) AS Longitude,
  s_name AS ListOfficeName,
  CASE WHEN l_suppkey%10=0 THEN ' nonmember  mrml' ELSE s_name END AS BuyerOfficeName,
  CASE WHEN l_orderkey%50=0 THEN 'One' END AS Levels,
  1990+l_linenumber AS TaxYear
FROM {lineitem} JOIN {orders} ON l_orderkey=o_orderkey JOIN {customer} ON o_custkey=c_custkey
JOIN {nation} ON c_nationkey=n_nationkey JOIN {region} ON n_regionkey=r_regionkey
JOIN {part} ON l_partkey=p_partkey JOIN {supplier} ON l_suppkey=s_suppkey
"""

# Listings: every row; some keys are of listings that were never sold.
LISTINGS_SQL = SOLD_SQL.replace("l_orderkey*10+l_linenumber AS", "(CASE WHEN l_partkey%13=0 THEN -1 ELSE 1 END)*(l_orderkey*10+l_linenumber) AS")

# Weekly rate series stand-in (several observations per day; averaged per month).
RATES_SQL = """
SELECT CAST(o_orderdate AS date) AS date, CAST(o_totalprice/100000.0 AS double) AS rate_30yr_fixed
FROM {orders}
"""

# District boundary stand-in: one shape per nation from a vertex template.
# shape 0 = square with a hole, 1 = triangle, 2 = two-part multipolygon,
# 3 = diamond; neighbours overlap so ties are exercised; every sixth nation is
# an 'Elementary' district that the join must ignore.
DISTRICTS_SQL = """
SELECT concat(n_name, ' Unified') AS DistrictName,
  CASE WHEN n_nationkey%6=5 THEN 'Elementary' ELSE 'Unified' END AS DistrictType,
  t.part AS part, t.ring AS ring, t.idx AS idx,
  CAST(-123.3+2.2*(n_nationkey%5)+t.dx AS double) AS x,
  CAST(33.4+0.38*(n_nationkey-n_nationkey%5)+t.dy AS double) AS y
FROM {nation} JOIN (VALUES
  (0,0,0,0,-1.3,-0.9),(0,0,0,1,1.3,-0.9),(0,0,0,2,1.3,0.9),(0,0,0,3,-1.3,0.9),(0,0,0,4,-1.3,-0.9),
  (0,0,1,0,-0.4,-0.3),(0,0,1,1,0.4,-0.3),(0,0,1,2,0.4,0.3),(0,0,1,3,-0.4,0.3),(0,0,1,4,-0.4,-0.3),
  (1,0,0,0,-1.2,-0.9),(1,0,0,1,1.2,-0.9),(1,0,0,2,0.05,1.0),(1,0,0,3,-1.2,-0.9),
  (2,0,0,0,-1.25,-0.95),(2,0,0,1,-0.1,-0.95),(2,0,0,2,-0.1,0.95),(2,0,0,3,-1.25,0.95),(2,0,0,4,-1.25,-0.95),
  (2,1,0,0,0.1,-0.95),(2,1,0,1,1.25,-0.95),(2,1,0,2,1.25,0.95),(2,1,0,3,0.1,0.95),(2,1,0,4,0.1,-0.95),
  (3,0,0,0,0.0,-1.05),(3,0,0,1,1.3,0.0),(3,0,0,2,0.0,1.05),(3,0,0,3,-1.3,0.0),(3,0,0,4,0.0,-1.05)
) AS t(shape, part, ring, idx, dx, dy) ON n_nationkey%4 = t.shape
"""

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def tables_of(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


# Table handles per session and folder: resolving a parquet table (listing,
# footer, schema) is driver work that need not be repeated per query. Only the
# lazy handle is kept; every query still reads the data when it runs.
_HANDLES: dict[tuple[int, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    key = (id(spark), os.path.abspath(sf_dir), name)
    df = _HANDLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
        _HANDLES[key] = df
    return df


def load(spark: SparkSession, sql: str, sf_dir: str) -> DataFrame:
    """Run a stand-in text on Spark over the parquet tables in ``sf_dir``."""
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in tables_of(sql)})


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inner join of ``SOLD_SQL`` with its small sides first: Spark joins in the
    order of the text, which deals the wide order lines out again for customers.
    Here orders meet their customers first, while they are narrow, and a filter on
    customers drops orders, thereby order lines, before parts are joined."""
    t = lambda name: table(spark, sf_dir, name)
    on = lambda a, b: F.col(a) == F.col(b)
    customers = t("customer").join(t("nation").join(t("region"), on("n_regionkey", "r_regionkey")), on("c_nationkey", "n_nationkey"))
    orders = t("orders").join(customers, on("o_custkey", "c_custkey"))
    return (t("lineitem").join(orders, on("l_orderkey", "o_orderkey")).join(t("supplier"), on("l_suppkey", "s_suppkey"))
            .join(t("part"), on("l_partkey", "p_partkey")))


def projected(spark: SparkSession, sql: str, sf_dir: str) -> DataFrame:
    """The projection of a sold or listings text over ``joined``."""
    return spark.sql(sql[:sql.index("\nFROM ")] + "\nFROM {joined}", joined=joined(spark, sf_dir))


def for_duckdb(sql: str) -> str:
    """The same text with placeholders bound to the driver's DuckDB views."""
    return sql.format(**{t: t for t in tables_of(sql)})


def sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected(spark, SOLD_SQL, sf_dir)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected(spark, LISTINGS_SQL, sf_dir)


def weekly_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, RATES_SQL, sf_dir)


def district_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, DISTRICTS_SQL, sf_dir)

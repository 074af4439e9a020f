"""Stand-in input for the listing job, derived from the driver tables.

The driver tables hold no NULLs and no messy text, so the `listings` view below
re-shapes lineitem/part/orders/customer/nation rows into the 19-column raw
listing schema (currency text, unit text, sentinels, duplicate keys, exact and
near copies). It only produces rows in the schema the job expects; every
cleaning, merging, parsing and fitting step runs on it through the library.
The same SQL text runs in Spark and in DuckDB, so the oracle sees identical
input.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

LISTING_COLUMNS = ["ad_id", "price", "property_size", "bedroom", "bathroom", "completion_year",
                   "floors", "total_units", "parking_lot", "address", "facilities",
                   "property_type", "floor_range", "tenure_type", "land_title", "school",
                   "nearby_school", "mall", "description"]

_BASE_COLUMNS = """
SELECT
  l_orderkey*8 + l_linenumber AS ad_id,
  'RM ' || cast(cast(floor(l_extendedprice*5/1000) AS bigint) AS string) || ' '
        || lpad(cast(cast(floor(l_extendedprice*5) AS bigint)%1000 AS string),3,'0') AS price,
  CASE WHEN l_partkey%499=0 THEN cast(cast(l_quantity*20+400 AS bigint)*100 AS string)
       WHEN l_partkey%997=1 THEN '1'
       ELSE cast(cast(l_quantity*20+400 AS bigint) AS string) END || ' sq.ft.' AS property_size,
  CASE WHEN l_suppkey%25=0 THEN '-' WHEN l_partkey%401=0 THEN '9' ELSE cast(l_linenumber%5+1 AS string) END AS bedroom,
  CASE WHEN l_suppkey%25=0 THEN '-' ELSE cast(l_linenumber%3+1 AS string) END AS bathroom,
  CASE WHEN l_partkey%2=0 THEN '-' ELSE cast(year(l_shipdate)+23 AS string) END AS completion_year,
  CASE WHEN l_suppkey%5<2 THEN '-' WHEN l_partkey%503=0 THEN '135' ELSE cast(p_size AS string) END AS floors,
  CASE WHEN l_suppkey%5<2 THEN 'N/A' ELSE cast(p_size*(l_suppkey%17+4) AS string) END AS total_units,
  CASE WHEN l_partkey%3=0 THEN '-' ELSE cast(l_partkey%6 AS string) END AS parking_lot,
  CASE WHEN l_suppkey%40=0 THEN NULL
       WHEN n_nationkey%5=0 THEN p_brand || ', Kampung Melaka, SELANGOR, Puchong'
       WHEN n_nationkey%5=1 THEN p_brand || ', Johor Bahru,  Johor '
       WHEN n_nationkey%5=2 THEN p_brand || ', Kuala Lumpur'
       WHEN n_nationkey=3 AND l_partkey%700=0 THEN p_brand || ', Kelantan'
       WHEN n_nationkey%5=3 THEN p_brand || ', Penang'
       ELSE p_brand || ', Kampung Melaka' END AS address,
  CASE WHEN l_suppkey%6=0 THEN '-' ELSE concat_ws(', ',
       CASE WHEN l_partkey%2=0 THEN 'Parking' END, CASE WHEN l_partkey%3=0 THEN 'swimming pool' END,
       CASE WHEN l_partkey%5=0 THEN 'Barbeque area' END, 'Security',
       CASE WHEN l_partkey%331=0 THEN '10' END) END AS facilities,
  CASE WHEN l_partkey%700=7 THEN 'Studio' WHEN l_partkey%90=1 THEN 'Others' WHEN p_type='PROMO' THEN 'Flat'
       WHEN p_type IN ('SMALL','MEDIUM') THEN 'Apartment' WHEN p_type='LARGE' THEN 'Service Residence' ELSE 'Condominium' END AS property_type,
  CASE l_returnflag WHEN 'A' THEN 'Low' WHEN 'N' THEN 'Medium' ELSE 'Unknown' END AS floor_range,
  CASE l_linestatus WHEN 'O' THEN 'Freehold' ELSE 'Leasehold' END AS tenure_type,
  CASE WHEN l_partkey%600=5 THEN 'Malay Reserved' WHEN l_suppkey%6=1 THEN 'Bumi Lot' ELSE 'Non Bumi Lot' END AS land_title,
  CASE WHEN l_partkey%7=0 THEN p_name END AS school,
  CASE WHEN l_partkey%14=0 THEN p_name END AS nearby_school,
  CASE WHEN l_suppkey%11=0 THEN c_mktsegment ELSE '-' END AS mall,
  CASE WHEN l_partkey%401=0 AND l_suppkey%2=0 THEN 'SQFT : 3000' || chr(10) || 'BEDROOMS : 6'
       WHEN l_partkey%401=0 THEN 'Land Area: ' || cast(cast(l_quantity*20+400 AS bigint)-50 AS string) || ' sq.ft, 3 Bed-rooms'
       WHEN l_partkey%13=0 THEN 'For sale only'
       ELSE cast(cast(l_quantity*20+400 AS bigint) AS string) || ' sqft unit, ' || cast(l_linenumber%5+1 AS string) || ' bedrooms + 2 bathroom' END AS description
"""

BASE_SQL = _BASE_COLUMNS + """FROM lineitem JOIN part ON l_partkey=p_partkey JOIN orders ON l_orderkey=o_orderkey
JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey
"""

_NEAR_COPY_COLS = ", ".join(
    "ad_id + 100000000 AS ad_id" if c == "ad_id"
    else "CASE WHEN ad_id % 2 = 0 THEN description ELSE description || ' NEGO' END AS description"
    if c == "description" else c
    for c in LISTING_COLUMNS)

EXTENDED_SQL = f"""
SELECT * FROM b
UNION ALL SELECT * FROM b WHERE ad_id % 100 = 0
UNION ALL SELECT {_NEAR_COPY_COLS} FROM b WHERE ad_id % 149 = 1
"""

# CTE fragment for oracles: "WITH <LISTINGS_CTE>, ... SELECT ..."
LISTINGS_CTE = f"b AS ({BASE_SQL}), listings AS ({EXTENDED_SQL})"


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for t in names:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# BASE_SQL's rows with EXTENDED_SQL's copies of each (0 itself, 1 exact, 2 near). Copies are made while
# rows are narrow; orders meet their customers first, so lineitem is shuffled by two keys at most.
_EXACT, _NEAR = "(l_orderkey*8 + l_linenumber) % 100 = 0", "(l_orderkey*8 + l_linenumber) % 149 = 1"
_COPIED_SQL = f"""{_BASE_COLUMNS}, __copy
FROM (SELECT *, explode(CASE WHEN {_EXACT} AND {_NEAR} THEN array(0, 1, 2) WHEN {_EXACT} THEN array(0, 1)
                        WHEN {_NEAR} THEN array(0, 2) ELSE array(0) END) AS __copy FROM lineitem)
JOIN (SELECT o_orderkey, c_mktsegment, n_nationkey FROM orders JOIN customer ON o_custkey=c_custkey
      JOIN nation ON c_nationkey=n_nationkey) ON l_orderkey=o_orderkey
JOIN part ON l_partkey=p_partkey
"""


def listings_plan(spark: SparkSession, sf_dir: str, n: int = 1, i: int = 0) -> DataFrame:
    """The raw 19-column listing table (all text except the key), as a plan: EXTENDED_SQL's
    rows, with the join run once instead of for each branch of its union. With `n` those of
    the orders of pass `i` of `n`."""
    register_tables(spark, sf_dir, ["part", "orders", "lineitem", "customer", "nation"])
    key, text, near = F.col("ad_id"), F.col("description"), F.col("__copy") == 2
    sql = _COPIED_SQL
    if n > 1:
        of_pass = f"pmod(xxhash64({{}}), {n}) = {i}"
        sql = sql.replace("FROM lineitem)", f"FROM lineitem WHERE {of_pass.format('l_orderkey')})") \
            .replace("n_nationkey) ON", f"n_nationkey WHERE {of_pass.format('o_orderkey')}) ON")
    return spark.sql(sql).withColumns({
        "ad_id": F.when(near, key + 100000000).otherwise(key),
        "description": F.when(near & (key % 2 != 0), F.concat(text, F.lit(" NEGO"))).otherwise(text),
    }).select(*LISTING_COLUMNS)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing table, materialised once per data folder under the shared
    checkpoint folder, so every job starts from a parquet scan of it (column
    pruning and filter pushdown apply) instead of re-running the five-way join. A large
    lineitem is joined in passes over the order keys, so that each shuffles its share."""
    from tableprep.session import PASS_ROWS, pass_count, path_exists, scratch_dir, write_passes
    tag = hashlib.md5(os.path.abspath(sf_dir).encode()).hexdigest()[:12]
    path = scratch_dir(spark, f"fixture-listings-{tag}")
    if not path_exists(spark, os.path.join(path, "_SUCCESS")):
        n = pass_count(table(spark, sf_dir, "lineitem"), 2 * PASS_ROWS)  # rows are narrow until they are joined
        write_passes(path, n, lambda i: listings_plan(spark, sf_dir, n, i))
    return spark.read.parquet(path)

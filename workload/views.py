"""Raw postings and taxonomy derived from ``orders`` and ``part`` (see FIXTURES.md).

The texts run unchanged in Spark SQL and in DuckDB.  All rows of both tables
take part; the remainders only vary the wording from row to row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postwright.operators.shaping import fill_cores

POSTINGS = """
SELECT
  CAST(o_orderkey AS STRING) AS system_job_id,
  CASE WHEN o_orderkey % 29 = 0 THEN 'N/A' ELSE concat(' J', CAST(o_custkey AS STRING), ' ') END AS job_id,
  p_name AS title,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS date_acquired,
  CASE WHEN o_orderkey % 9 = 0 THEN 'unknown' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS created_date,
  CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN ' true ' WHEN 2 THEN 'TRUE' WHEN 3 THEN 'yes' ELSE 'false' END AS expired,
  CASE o_orderkey % 4 WHEN 0 THEN CAST(20000 + o_orderkey % 90000 AS STRING) WHEN 1 THEN 'n.a.' WHEN 2 THEN '1,000' ELSE NULL END AS parameters_salary_min,
  CASE o_orderkey % 6 WHEN 0 THEN ' 5e4 ' ELSE NULL END AS parameters_salary_max,
  CASE o_orderkey % 8 WHEN 0 THEN 'Year' WHEN 1 THEN '' ELSE NULL END AS parameters_salary_unit,
  concat(
    '<p>We need a ', p_name, ' expert, blue bolt &amp; hot gear.</p>  ',
    CASE o_orderkey % 6
      WHEN 0 THEN concat('Pay $', CAST(15 + o_orderkey % 40 AS STRING), '.50 - $', CAST(30 + o_orderkey % 40 AS STRING), ' per hour. ')
      WHEN 1 THEN concat('Pay $', CAST(40 + o_orderkey % 50 AS STRING), ',000 to $', CAST(95 + o_orderkey % 5 AS STRING), ',500 annually. ')
      WHEN 2 THEN concat(CAST(45 + o_orderkey % 50 AS STRING), 'K-99k/yr ')
      WHEN 3 THEN '$5 monthly then 70k year '
      ELSE 'Competitive. ' END,
    CASE o_orderkey % 5 WHEN 0 THEN 'Bachelor degree or MBA. ' WHEN 1 THEN 'High school or GED. ' WHEN 2 THEN 'Ph.D preferred. ' WHEN 3 THEN 'Associate degree. ' ELSE '' END,
    CASE o_orderkey % 11 WHEN 0 THEN concat(CAST(1 + o_orderkey % 12 AS STRING), '+ years of experience. ') WHEN 1 THEN '2 to 5 years relevant work experience. ' WHEN 2 THEN 'three yrs experience. ' WHEN 3 THEN '2-5 years of experience. ' WHEN 4 THEN '60 years experience. ' ELSE '' END,
    CASE o_orderkey % 3 WHEN 0 THEN 'Full-time remote. ' WHEN 1 THEN 'Part time contract, dental and 401k. ' ELSE 'Internship with PTO. ' END,
    CASE o_orderkey % 13 WHEN 0 THEN 'Tuition benefit, relocation package, sign-on bonus. ' WHEN 1 THEN 'Tuition reimbursement, signing bonus, telecommuting. ' ELSE '' END,
    'Call (303) 555-', CAST(1000 + o_orderkey % 9000 AS STRING), ' or see https://x.example/', CAST(o_orderkey AS STRING)
  ) AS description
FROM orders JOIN part ON p_partkey = o_orderkey % (SELECT count(*) FROM part)
"""

#: Line breaks of both kinds and quotes, as the end of a description.
LINES = (
    "concat(chr(10), '\"', {0}, '\", they said', chr(13), chr(10), chr(10), 'and \"left\", too')"
)

#: Ids with blanks around every third one, and one missing.
LOOSE_IDS = (
    "CASE WHEN CAST({0} AS BIGINT) = 7 THEN NULL "
    "WHEN CAST({0} AS BIGINT) % 3 = 0 THEN concat('  ', {0}, ' ') ELSE {0} END"
)

TAXONOMY = """
SELECT
  CAST(p_partkey % 60 AS STRING) AS research_id,
  CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN concat('  ', upper(p_name), ' ') WHEN p_partkey % 13 = 0 THEN 'dental' ELSE p_name END AS raw_skill,
  concat(split_part(p_name, ' ', 2), ' ', lower(p_type)) AS taxonomy_skill,
  CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE concat('uses a ', p_name, ' of brand ', p_brand) END AS taxonomy_description,
  CASE WHEN p_partkey % 50 = 3 THEN 'other' WHEN p_partkey % 50 = 4 THEN NULL WHEN p_partkey % 3 = 0 THEN 'esco' WHEN p_partkey % 3 = 1 THEN 'onet_tech' ELSE 'onet_skill' END AS taxonomy_source,
  CAST(25 + p_partkey % 75 AS DOUBLE) / CAST(100 AS DOUBLE) AS correlation
FROM part
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return fill_cores(spark.read.parquet(f"{folder}/{name}.parquet"))


def postings_from(orders: DataFrame, part: DataFrame) -> DataFrame:
    parts = part.count()  # the keys run from 0 to this
    sql = POSTINGS.replace("FROM orders JOIN part", "FROM {orders} JOIN {part}")
    sql = sql.replace("(SELECT count(*) FROM part)", str(parts))
    return orders.sparkSession.sql(sql, orders=orders, part=part)


def postings(spark: SparkSession, folder: str) -> DataFrame:
    # dealt by the key of the join, so that the tasks that make and clean the texts stay as many
    part = table(spark, folder, "part")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    return postings_from(fill_cores(orders, F.col("o_orderkey") % F.lit(part.count())), part)


def taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return spark.sql(TAXONOMY.replace("FROM part", "FROM {part}"), part=part)

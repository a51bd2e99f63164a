"""An award register made of the star schema's tables, so that operators can be held against SQL on known data.

It tests how rows are matched, joined and summed; its amounts are no subsidies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCES = {"1-URGENT": "TAM", "2-HIGH": "KOHESIO", "3-MEDIUM": "RRF", "4-NOT SPECIFIED": "FTS", "5-LOW": "IPCEI_state_aid"}
INSTRUMENTS = ["grant", "loan", "guarantee", "Tax advantage", "mixed"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    # orders meet their small tables before they are dealt to their many lines
    sold = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    placed = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    joined = sold.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    source, instrument = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, v in SOURCES.items():
        source = F.when(F.col("o_orderpriority") == k, v).otherwise(source)
    for i, v in enumerate(INSTRUMENTS):
        instrument = F.when(F.col("p_size") % 5 == i, v).otherwise(instrument)
    return joined.select(
        source.alias("source"), F.col("l_orderkey").cast("string").alias("source_record_id"), F.col("c_name").alias("beneficiary_name"), F.col("c_name").alias("match_reference_name"),
        F.lower("c_name").alias("entity_name_clean"), F.col("n_name").alias("country"), instrument.alias("financial_instrument_class"), F.col("o_orderstatus").alias("fiscal_source_type"),
        F.year("o_orderdate").alias("year"), F.col("l_extendedprice").alias("amount_eur"), F.col("r_name").alias("parent_group"), F.col("p_type").alias("programme"), F.col("p_name").alias("description"),
        F.lit("").alias("fund"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("ord"), F.lit("True").alias("is_primary_record"),
    )


def _case(column: str, values: dict) -> str:
    return f"CASE {' '.join(f'WHEN {column} = {k!r} THEN {v!r}' for k, v in values.items())} END"


AWARDS_SQL = f"""awards AS (
  SELECT {_case('o_orderpriority', SOURCES)} AS source, CAST(l_orderkey AS VARCHAR) AS source_record_id, c_name AS beneficiary_name, c_name AS match_reference_name, lower(c_name) AS entity_name_clean,
    n_name AS country, {_case('p_size % 5', dict(enumerate(INSTRUMENTS)))} AS financial_instrument_class, o_orderstatus AS fiscal_source_type, CAST(year(o_orderdate) AS INTEGER) AS year,
    l_extendedprice AS amount_eur, r_name AS parent_group, p_type AS programme, p_name AS description, l_orderkey * 100 + l_linenumber AS ord
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
)"""

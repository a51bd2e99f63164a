"""The list of organisations to look for, and its lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.config import MatchConfig
from tallyloom.functions.text import clean_name, significant_tokens, stripped

ALIASES = "alias string, canonical string"
REFERENCES = "ref_name_raw string, ref_name_clean string, ref_country string, ref_source string, ord bigint"


def alias_table(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(pairs, ALIASES)


def reference_list(listed: DataFrame, aliases: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """The references: each row of the list whose name says something, then canonical names that only aliases give.

    listed has company_name, and may have country and source; ord keeps its order.
    """
    if "company_name" not in listed.columns:
        raise ValueError("the list has no column company_name")
    optional = lambda name: F.col(name).cast("string") if name in listed.columns else F.lit(None).cast("string")
    rows = listed.select(
        stripped(F.col("company_name")).alias("ref_name_raw"), clean_name(F.col("company_name")).alias("ref_name_clean"),
        F.substring(F.trim(F.coalesce(optional("country"), F.lit(""))), 1, 2).alias("ref_country"),
        F.coalesce(F.nullif(F.trim(optional("source")), F.lit("")), F.lit("company_list")).alias("ref_source"), F.monotonically_increasing_id().alias("ord"),
    )
    excluded = sorted(config.master_exclude)
    usable = (F.col("ref_name_clean") != "") & ~F.col("ref_name_clean").isin(excluded)
    own = rows.filter(usable)
    named = aliases.select(stripped(F.col("canonical")).alias("ref_name_raw"), clean_name(F.col("canonical")).alias("ref_name_clean")).filter(usable)
    more = named.groupBy("ref_name_clean").agg(F.min("ref_name_raw").alias("ref_name_raw")).join(own.select("ref_name_clean"), "ref_name_clean", "left_anti")
    added = more.select("ref_name_raw", "ref_name_clean", F.lit("").alias("ref_country"), F.lit("aliases").alias("ref_source"), (F.lit(1 << 60) + F.row_number().over(Window.orderBy("ref_name_clean"))).alias("ord"))
    return own.unionByName(added)


def clean_aliases(aliases: DataFrame, references: DataFrame) -> DataFrame:
    """alias and canonical, both clean, for aliases of a reference that are no reference themselves; the first canonical in order of name counts."""
    known = references.select(F.col("ref_name_clean").alias("canonical")).distinct()
    cleaned = aliases.select(clean_name(F.col("alias")).alias("alias"), clean_name(F.col("canonical")).alias("canonical")).filter("alias <> ''")
    fit = cleaned.join(known, "canonical").join(known.select(F.col("canonical").alias("alias")), "alias", "left_anti")
    return fit.groupBy("alias").agg(F.min("canonical").alias("canonical"))


def exact_lookup(references: DataFrame, aliases: DataFrame) -> DataFrame:
    """name, ref and notes: every reference as itself, and every alias."""
    own = references.select(F.col("ref_name_clean").alias("name")).distinct().select("name", F.col("name").alias("ref"), F.lit("").alias("notes"))
    other = clean_aliases(aliases, references).select(F.col("alias").alias("name"), F.col("canonical").alias("ref"), F.concat(F.lit("alias:"), "alias").alias("notes"))
    return own.unionByName(other)


def token_index(references: DataFrame) -> DataFrame:
    """token and ref, for each significant token of each reference."""
    return references.select(F.col("ref_name_clean").alias("ref")).distinct().select("ref", F.explode(significant_tokens(F.col("ref"))).alias("token"))


def context_terms(references: DataFrame, aliases: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """term, ref and is_alias: what is looked for inside texts."""
    lookup = exact_lookup(references, aliases)
    fit = lookup.filter((F.length("name") >= config.context_min_len) & ~F.col("name").isin(sorted(config.contextual_blocklist)))
    return fit.select(F.col("name").alias("term"), "ref", (F.col("name") != F.col("ref")).alias("is_alias"))


def raw_names(references: DataFrame) -> DataFrame:
    """ref and raw, as the last row of the list spells it."""
    return references.groupBy(F.col("ref_name_clean").alias("ref")).agg(F.max_by("ref_name_raw", "ord").alias("raw"))


def reference_countries(references: DataFrame) -> DataFrame:
    """ref and the countries that the list gives for it."""
    country = F.upper(F.trim("ref_country"))
    return references.groupBy(F.col("ref_name_clean").alias("ref")).agg(F.array_sort(F.collect_set(F.when(country != "", country))).alias("countries"))

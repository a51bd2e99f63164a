"""Quality, grant equivalents, parent groups and origin of matched rows, and the union with enrichment rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import constants as K
from tallyloom.functions.amounts import country_block, grant_rate, looked_up, number
from tallyloom.functions.text import EDGE, clean_for_group, found, stripped

UNATTRIBUTED = ["unattributed_consortium_rd", "unattributed_rd"]


def cordis_company(pattern: str) -> Column:
    """The organisation that a bridge row is about: in the beneficiary or among the project's partners, by the row's signal."""
    beneficiary, partners, signal = (F.coalesce(F.col(c), F.lit("")) for c in ("beneficiary_name", "company_names", "signal"))
    own, other = F.trim(found(beneficiary, pattern, 1)), F.trim(found(partners, pattern, 1))
    return (
        F.when(signal == "beneficiary_name", F.when(own != "", own).otherwise(F.trim(F.substring_index(beneficiary, "*", 1))))
        .when(signal.isin("cordis_company", "company+topic"), F.when(other != "", other).when(own != "", own).otherwise(UNATTRIBUTED[0]))
        .otherwise(F.when(own != "", own).otherwise(UNATTRIBUTED[1]))
    )


def new_records(rows: DataFrame, core: DataFrame, source: str) -> DataFrame:
    """rows whose record id isn't among core's of that source."""
    known = core.filter(F.col("source") == source).select(F.col("source_record_id").cast("string").alias("_known")).distinct()
    return rows.join(known, rows["source_record_id"].cast("string") == F.col("_known"), "left_anti")


def with_columns_of(target: DataFrame, rows: DataFrame, fill_text: bool = False) -> DataFrame:
    """rows in target's columns; missing ones are null, or 'unknown' for text if asked."""
    kinds = dict(target.dtypes)
    missing = lambda c: F.lit("unknown" if fill_text and kinds[c] == "string" else None).cast(kinds[c])
    return rows.select(*(F.col(c).try_cast(kinds[c]).alias(c) if c in rows.columns else missing(c).alias(c) for c in target.columns))


def integrate(core: DataFrame, pattern: str, bridge: DataFrame | None = None, promoters: DataFrame | None = None, projects: DataFrame | None = None, prefix: str = "match") -> dict[str, DataFrame]:
    """core and the rows that enrichment adds, by name: combined, and those of each source. Rows that core has already stay out."""
    ref, kind, score = (f"{prefix}_{x}" for x in ("reference_name", "type", "score"))
    base = core if "match_quality" in core.columns else core.withColumn("match_quality", F.lit("confirmed"))
    parts: dict[str, DataFrame] = {}
    if bridge is not None:
        signal = F.coalesce(F.col("signal"), F.lit("unknown"))
        instrument = F.col("financial_instrument_class") if "financial_instrument_class" in bridge.columns else F.lit("grant")
        rows = new_records(bridge, core, "FTS").withColumns({"source": F.lit("FTS_CORDIS"), "financial_instrument_class": instrument, "fiscal_source_type": F.lit("eu_budget_direct"), ref: cordis_company(pattern)})
        rows = rows.filter(~F.col(ref).isin(UNATTRIBUTED))
        parts["fts_cordis"] = rows.withColumns({kind: F.concat(F.lit("fts_cordis_"), signal), score: looked_up(signal, K.SIGNAL_SCORES, 50.0), "match_quality": looked_up(signal, K.SIGNAL_QUALITY, "unclassified")})
    if promoters is not None:
        parts["eib_promoter"] = new_records(promoters, core, "EIB").withColumns({"source": F.lit("EIB"), "financial_instrument_class": F.lit("loan"), "fiscal_source_type": F.lit("ifi_balance_sheet")})
    if projects is not None:
        named = F.coalesce(*(F.col(c) for c in (ref, "matched_company", "company") if c in projects.columns), F.lit(""))
        rows = projects.filter(number(F.col("amount_eur")) > 0).withColumns({"source": F.lit("IPCEI_state_aid"), "financial_instrument_class": F.lit("grant"), "fiscal_source_type": F.lit("national_budget"), ref: named})
        parts["ipcei"] = rows.withColumns({c: F.lit(v) for c, v in ((kind, "ipcei_reference"), (score, 100.0)) if c not in rows.columns})
    combined = base
    for name, rows in parts.items():
        combined = combined.unionByName(with_columns_of(base, rows, fill_text=name == "fts_cordis"))
    return {"combined": combined, **parts}


def integration_stats(parts: dict[str, DataFrame], allowances: DataFrame | None = None) -> dict[str, dict]:
    """Rows and euros that each source adds; free allowances are told apart and never added to totals."""
    out = {name: dict(zip(("rows", "eur"), rows.agg(F.count("*"), F.coalesce(F.sum("amount_eur"), F.lit(0.0))).first(), strict=True)) for name, rows in parts.items() if name != "combined"}
    if allowances is not None:
        out["ets"] = dict(zip(("rows", "eur"), allowances.agg(F.count("*"), F.coalesce(F.sum("total_eur_free"), F.lit(0.0))).first(), strict=True)) | {"note": "reported separately"}
    return out


def add_quality(rows: DataFrame, prefix: str = "match") -> DataFrame:
    """suspect_description_only where a description names the reference and the beneficiary has none of its words."""
    forms = f"(?iU){EDGE}(?:{'|'.join(K.QUALITY_FORMS)}){EDGE}\\.?"
    words = F.filter(F.split(stripped(F.regexp_replace(F.lower(stripped(F.col(f"{prefix}_reference_name"))), forms, "")), r"(?U)\s+"), lambda w: F.length(w) > 2)
    beneficiary = F.lower(F.coalesce(F.col("beneficiary_name"), F.lit("")))
    named = (F.size(words) == 0) | F.exists(words, lambda w: beneficiary.contains(w))
    suspect = (F.col(f"{prefix}_matched_on") == "description") & F.col("source").isin("KOHESIO", "FTS", "CINEA") & ~named
    old = F.coalesce(F.col("match_quality"), F.lit("confirmed")) if "match_quality" in rows.columns else F.lit("confirmed")
    return rows.withColumn("match_quality", F.when(suspect, "suspect_description_only").otherwise(old))


def add_grant_equivalent(rows: DataFrame) -> DataFrame:
    """gge_rate and amount_gge: by instrument, unless the register tells the aid element itself."""
    subtype = F.col("instrument_subtype") if "instrument_subtype" in rows.columns else None
    amount = number(F.col("amount_eur"))
    told = number(F.col("amount_gge_eur")) if "amount_gge_eur" in rows.columns else F.lit(None).cast("double")
    rate = grant_rate(F.col("financial_instrument_class"), subtype)
    return rows.withColumns({"amount_gge": F.coalesce(told, amount * rate), "gge_rate": F.when(told.isNull(), rate).when(amount > 0, told / amount)})


def group_members(spark: SparkSession, groups: dict[str, list[str]]) -> DataFrame:
    """group, member and ord of a run's parent groups."""
    rows = [(g, m, i) for i, (g, m) in enumerate((g, m) for g, members in groups.items() for m in members)]
    return spark.createDataFrame(rows, "group string, member string, ord int")


def parent_groups(names: DataFrame, members: DataFrame, name: str = "name") -> DataFrame:
    """name and parent_group: the group of the longest member that holds the clean name or is held by it, the first of equals; else the name itself.

    Members are few and names distinct, so each name is held against each member.
    """
    distinct = names.select(F.col(name).alias("name")).filter("name IS NOT NULL").distinct().withColumn("_clean", clean_for_group(F.col("name")))
    fits = (F.col("_clean") != "") & (F.col("member") != "") & (F.col("_clean").contains(F.col("member")) | F.col("member").contains(F.col("_clean")))
    best = distinct.join(members, fits, "left").groupBy("name").agg(F.max_by("group", F.struct(F.length("member"), -F.col("ord"))).alias("group"))
    return best.select("name", F.coalesce("group", "name").alias("parent_group"))


def add_parent_group(rows: DataFrame, members: DataFrame, ref: str = "match_reference_name") -> DataFrame:
    found_groups = parent_groups(rows, members, ref).select(F.col("name").alias("_name"), "parent_group")
    return rows.join(found_groups, F.col(ref) == F.col("_name"), "left").drop("_name")


def add_origin(rows: DataFrame, listed: DataFrame, ref: str = "match_reference_name") -> DataFrame:
    """hq_country and origin_block from the list's hq_country, by group if there are groups, in any case of letters."""
    key = lambda c: F.upper(stripped(c))
    places = listed.groupBy(key(F.col("company_name")).alias("_key")).agg(F.max(F.upper(F.trim("hq_country"))).alias("_hq"))
    by = "parent_group" if "parent_group" in rows.columns else ref
    joined = rows.join(places, key(F.col(by)) == F.col("_key"), "left")
    return joined.withColumns({"origin_block": country_block(F.col("_hq")), "hq_country": F.coalesce(F.nullif("_hq", F.lit("")), F.lit("Unknown"))}).withColumn("origin_desc", F.col("origin_block")).drop("_key", "_hq")

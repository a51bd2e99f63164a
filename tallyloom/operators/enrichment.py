"""Five enrichments of matched awards from side tables, each a function of DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import constants as K
from tallyloom.config import Keywords
from tallyloom.functions.amounts import allowance_price, match_probability
from tallyloom.functions.rows import row_key
from tallyloom.functions.text import any_pattern, clean_plain, found, grant_id, has, json_text, search_text

# --- payments of research programmes and their projects' partners -------------------------------------------


def research_payments(payments: DataFrame) -> DataFrame:
    """Payments of research programmes with cordis_project_id, the grant that their description begins with (null if none)."""
    return payments.filter(has(F.col("programme"), f"(?i){K.RESEARCH_PROGRAMMES}")).withColumn("cordis_project_id", grant_id(F.col("description")))


def project_companies(participants: DataFrame) -> DataFrame:
    """Per project, the companies that take part: names, countries, their number and their money."""
    rows = participants.filter(F.col("activity_type") == "PRC").withColumn("project_id", F.col("project_id").try_cast("bigint")).filter("project_id IS NOT NULL")
    return rows.groupBy("project_id").agg(
        F.concat_ws("|", F.array_sort(F.collect_set("org_name"))).alias("company_names"), F.concat_ws(",", F.array_sort(F.collect_set("org_country"))).alias("company_countries"),
        F.countDistinct("org_name").alias("n_companies"), F.coalesce(F.sum("ec_contribution"), F.lit(0.0)).alias("total_company_ec"),
    )


def project_bridge(payments: DataFrame, participants: DataFrame) -> DataFrame:
    """Research payments with their projects' companies."""
    companies = project_companies(participants)
    return research_payments(payments).join(companies, F.col("cordis_project_id") == F.col("project_id"), "left").drop("project_id")


def sector_signals(bridge: DataFrame, companies: str, topics: str) -> DataFrame:
    """Bridge rows that name a company or a topic, with the signal that tells most."""
    partner, topic, own = has(F.col("company_names"), companies), has(F.col("description"), topics), has(F.col("beneficiary_name"), companies)
    signal = F.when(own, "beneficiary_name").when(partner & topic, "company+topic").when(topic, "topic_keyword").when(partner, "cordis_company")
    return bridge.withColumn("signal", signal).filter("signal IS NOT NULL")


# --- emission allowances ------------------------------------------------------------------------------------


def matching_installations(installations: DataFrame, companies: str, nace: str | None = None) -> DataFrame:
    """Installations of an activity or of a listed company, with how they were found and the company named."""
    code = F.col("nace_id").cast("string")
    by_code = F.coalesce(code.startswith(nace), F.lit(False)) if nace else F.lit(False)
    by_name = has(F.col("name"), companies)
    method = F.when(by_code & by_name, "both").when(by_code, "nace_only").otherwise("name_only")
    company = F.when(by_name, F.lower(found(F.col("name"), companies, 1))).otherwise(F.col("name"))
    return installations.filter(by_code | by_name).withColumns({"nace_str": code, "match_method": method, "company": company})


def allocations(installations: DataFrame, compliance: DataFrame) -> DataFrame:
    """Compliance rows of the installations, with prices and values in euros; ids meet as text."""
    own = installations.select(F.col("id").cast("string").alias("installation_id"), "name", "registry_id", "nace_id", "nace_str", "city", "match_method", "company")
    rows = compliance.withColumn("installation_id", F.col("installation_id").cast("string")).join(own, "installation_id").withColumn("eua_price", allowance_price(F.col("year")))
    return rows.withColumns({f"eur_{name}": F.col(c) * F.col("eua_price") for name, c in (("free_allocation", "allocatedFree"), ("total_allocation", "allocatedTotal"), ("verified_emissions", "verified"))})


def _sum(c: str, name: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0.0)).alias(name)


def allocations_by_company_year(rows: DataFrame) -> DataFrame:
    known = rows.filter("company IS NOT NULL AND year IS NOT NULL")
    return known.groupBy("company", "year").agg(
        F.countDistinct("installation_id").alias("installations"), F.countDistinct("registry_id").alias("countries"), _sum("allocatedFree", "free_allowances"), _sum("allocatedTotal", "total_allowances"),
        _sum("verified", "verified_emissions"), _sum("eur_free_allocation", "eur_free"), _sum("eur_total_allocation", "eur_total"),
    )


def allocations_by_company(rows: DataFrame) -> DataFrame:
    out = rows.filter("company IS NOT NULL").groupBy("company").agg(
        F.countDistinct("installation_id").alias("installations"), F.concat_ws(",", F.array_sort(F.collect_set("registry_id"))).alias("countries"), F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        _sum("allocatedFree", "total_free_allowances"), _sum("verified", "total_verified_emissions"), _sum("eur_free_allocation", "total_eur_free"),
    )
    return out.orderBy(F.desc("total_eur_free"), "company")


def allocations_by_phase(rows: DataFrame) -> DataFrame:
    """Sums by trading phase over rows with a free allocation, with the net benefit: free allocation less emissions."""
    year = F.col("year").cast("int")
    phase = F.lit(None).cast("string")
    for name, first, last in reversed(K.TRADING_PHASES):
        phase = F.when(year.between(first, last), name).otherwise(phase)
    sums = rows.filter("allocatedFree > 0").withColumn("phase", phase).filter("phase IS NOT NULL").groupBy("phase").agg(_sum("allocatedFree", "allowances"), _sum("eur_free_allocation", "eur_free"), _sum("eur_verified_emissions", "eur_verified"))
    return sums.withColumn("net_benefit_eur", F.col("eur_free") - F.col("eur_verified")).orderBy("phase")


# --- projects of common interest ----------------------------------------------------------------------------


def listed_participants(participants: DataFrame, names: DataFrame) -> DataFrame:
    """Participants with matched_company, the first name of names (name, ord) that holds the participant's or is held by it, whole or without brackets, or
    shares all words with it where there are two or more. The list is short, so each participant is held against each name."""
    p = F.lower(F.trim(F.coalesce(F.col("company"), F.lit(""))))
    core = F.trim(F.regexp_replace(p, r"\([^)]*\)", ""))
    rows = participants.withColumns({"_id": row_key(participants), "_p": p, "_core": core, "_words": F.array_distinct(F.filter(F.split(core, r"\s+"), lambda w: w != ""))})
    listed = names.select(F.col("name").alias("_name"), F.col("ord").alias("_ord"), F.lower(F.trim("name")).alias("_n")).filter("_n <> ''").withColumn("_own", F.array_distinct(F.split("_n", r"\s+")))
    inside = lambda a, b: (F.col(a) != "") & (F.col(b) != "") & (F.col(a).contains(F.col(b)) | F.col(b).contains(F.col(a)))
    within = lambda a, b: (F.size(a) >= 2) & (F.size(F.array_except(a, b)) == 0)
    fits = inside("_p", "_n") | inside("_core", "_n") | within("_own", "_words") | within("_words", "_own")
    best = rows.select("_id", "_p", "_core", "_words").join(listed, fits).groupBy("_id").agg(F.min_by("_name", "_ord").alias("matched_company"))
    return rows.join(best, "_id").drop("_id", "_p", "_core", "_words")


def project_awards(participants: DataFrame, names: DataFrame, overview: DataFrame | None = None) -> DataFrame:
    """Matched participants as awards; the year is that of the project's approval."""
    rows = listed_participants(participants, names)
    amount = F.col("amount_eur_est").try_cast("double") if "amount_eur_est" in rows.columns else F.lit(None).cast("double")
    out = rows.withColumns({"amount_eur": amount, "source": F.lit("IPCEI_state_aid"), "beneficiary_name": F.col("company"), "financial_instrument_class": F.lit("grant"), "fiscal_source_type": F.lit("national_budget")})
    if overview is None:
        return out
    years = overview.groupBy(F.col("ipcei_name").alias("_ipcei")).agg(F.max(F.substring(F.col("approval_date").cast("string"), 1, 4).try_cast("int")).alias("year"))
    return out.join(years, F.col("ipcei") == F.col("_ipcei"), "left").drop("_ipcei")


# --- what matching missed -----------------------------------------------------------------------------------


def unmatched(awards: DataFrame, matched: DataFrame) -> DataFrame:
    """Primary awards whose source and record id aren't among the matched."""
    known = matched.select(F.col("source").alias("_s"), F.col("source_record_id").cast("string").alias("_i")).distinct()
    primary = awards.filter(F.lower(F.col("is_primary_record").cast("string")) == "true")
    return primary.join(known, (F.col("source") == F.col("_s")) & (F.col("source_record_id").cast("string") == F.col("_i")), "left_anti")


_MINED = ["source_record_id", "beneficiary_name", "entity_name_clean", "country", "amount_eur", "year", "programme"]


def keyword_hits(payments: DataFrame, keywords: Keywords) -> DataFrame:
    """Payments that fit a pattern of the first tier, else of the second, with what was found."""
    text = search_text(F.col("description"), F.col("beneficiary_name"), F.col("programme"), json_text(F.col("original_columns")))
    one, two = any_pattern(keywords.tier1), any_pattern(keywords.tier2)
    rows = payments.withColumn("_text", text)
    tier = F.when(F.col("_text").rlike(one), "tier1").when(F.col("_text").rlike(two), "tier2")
    word = F.when(F.col("keyword_tier") == "tier1", F.regexp_extract("_text", one, 0)).otherwise(F.regexp_extract("_text", two, 0))
    return rows.withColumn("keyword_tier", tier).filter("keyword_tier IS NOT NULL").select(*_MINED, F.substring("description", 1, 200).alias("description"), word.alias("keyword_matched"), "keyword_tier")


def entity_candidates(payments: DataFrame, companies: str, keywords: Keywords = Keywords()) -> DataFrame:
    """Payments whose beneficiary names a company, one for each record and company, the largest first."""
    matched = found(clean_plain(F.col("beneficiary_name")), companies)
    context = has(F.col("description"), any_pattern(keywords.tier1)) if keywords.tier1 else F.lit(True)
    rows = payments.withColumns({"matched_company": matched, "has_sector_context": context}).filter("matched_company <> ''")
    sure = F.when(F.col("has_sector_context") | F.lit(not (keywords.tier1 or keywords.tier2)), "high").otherwise("medium")
    picked = rows.select(*_MINED, F.substring("description", 1, 200).alias("description"), "matched_company", "has_sector_context", sure.alias("confidence"))
    first = picked.groupBy("source_record_id", "matched_company").agg(F.max_by(F.struct(*(c for c in picked.columns if c not in ("source_record_id", "matched_company"))), F.struct("amount_eur", "beneficiary_name")).alias("r"))
    return first.select("source_record_id", "matched_company", "r.*").orderBy(F.desc("amount_eur"), "source_record_id", "matched_company")


def company_statistics(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("matched_company").agg(F.count("amount_eur").alias("rows"), _sum("amount_eur", "total_eur")).orderBy(F.desc("total_eur"), "matched_company")


def recommended_aliases(candidates: DataFrame) -> DataFrame:
    """Names under which candidates stand, with the company they were found by."""
    rows = candidates.filter(F.coalesce("entity_name_clean", F.lit("")) != "")
    out = rows.groupBy("entity_name_clean", F.col("matched_company").alias("recommended_canonical")).agg(F.count("*").alias("rows"), _sum("amount_eur", "total_eur"), F.max_by("beneficiary_name", F.struct("amount_eur", "source_record_id")).alias("sample_beneficiary"))
    return out.orderBy(F.desc("total_eur"), "entity_name_clean", "recommended_canonical")


def largest(awards: DataFrame, least: float = 1_000_000, n: int = 500) -> DataFrame:
    return awards.filter(F.col("amount_eur") > least).orderBy(F.desc("amount_eur"), "source", "source_record_id").limit(n)


def scan_totals(payments: DataFrame, matched: DataFrame) -> DataFrame:
    """One row: payments and euros, and those matched and not."""
    rest = unmatched(payments, matched).agg(F.count("*").alias("unmatched_rows"), _sum("amount_eur", "unmatched_eur"))
    every = payments.filter(F.lower(F.col("is_primary_record").cast("string")) == "true").agg(F.count("*").alias("rows"), _sum("amount_eur", "total_eur"))
    return every.crossJoin(rest).withColumns({"matched_rows": F.col("rows") - F.col("unmatched_rows"), "matched_eur": F.col("total_eur") - F.col("unmatched_eur")})


def forensics(awards: DataFrame, companies: str, keywords: Keywords = Keywords(), nace: str | None = None, least: float = 500_000, n: int = 500) -> DataFrame:
    """The largest unmatched awards, with how likely each is a missed match and why."""
    top = largest(awards, least, n)
    text = search_text(F.col("beneficiary_name"), F.col("description"), json_text(F.col("original_columns")))
    one, two = any_pattern(keywords.tier1), any_pattern(keywords.tier2)
    own = F.coalesce(F.col("nace_2digit").cast("string"), F.lit(""))
    rows = top.withColumns({"_text": text, "nace_2digit": own}).withColumns({
        "has_strong_keyword": F.col("_text").rlike(one), "has_medium_keyword": F.col("_text").rlike(two), "has_known_company": has(F.col("beneficiary_name"), companies),
        "has_nace_match": (own != "") & (F.substring(own, 1, 2) == nace[:2]) if nace else F.lit(False),
    })
    flags = [F.col(c) for c in ("has_known_company", "has_strong_keyword", "has_medium_keyword", "has_nace_match")]
    word = F.when(flags[1], F.regexp_extract("_text", one, 0)).when(flags[2], F.regexp_extract("_text", two, 0)).otherwise("")
    return rows.select(
        "source", "source_record_id", F.substring(F.coalesce("beneficiary_name", F.lit("")), 1, 100).alias("beneficiary_name"), "country", "amount_eur", "year", F.substring("description", 1, 200).alias("description"), "programme", "nace_2digit",
        "financial_instrument_class", match_probability(*flags).alias("match_probability"), word.alias("keyword_signal"), found(F.col("beneficiary_name"), companies).alias("company_signal"),
        "has_strong_keyword", "has_medium_keyword", "has_known_company", "has_nace_match",
    ).orderBy(F.desc("amount_eur"), "source", "source_record_id")


def new_candidates(found_rows: DataFrame) -> DataFrame:
    return found_rows.filter(F.col("match_probability").isin("very_high", "high", "medium"))


def unmatched_statistics(rows: DataFrame, least: float = 500_000) -> DataFrame:
    big = F.col("amount_eur") > least
    return rows.filter("source IS NOT NULL").groupBy("source").agg(F.count("*").alias("rows"), _sum("amount_eur", "total_eur"), F.count_if(big).alias("high_value_rows"), F.coalesce(F.sum(F.when(big, F.col("amount_eur"))), F.lit(0.0)).alias("high_value_eur")).orderBy(F.desc("total_eur"), "source")


def value_counts(rows: DataFrame, c: str) -> DataFrame:
    return rows.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), c)


def company_names(listed: DataFrame, aliases: list[tuple[str, str]] = ()) -> list[str]:
    """The names of a user's list (a bounded, user-supplied table) and its aliases, from the first column with name in its header."""
    column = next((c for c in listed.columns if "name" in c.lower()), listed.columns[0])
    own = [r[0].strip() for r in listed.select(F.col(column).cast("string")).filter(F.col(column).isNotNull()).collect()]
    return list(dict.fromkeys([*own, *(x for pair in aliases for x in pair)]))



"""Matching award records to references: by name (exact, then by likeness), then inside texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import constants as K
from tallyloom.config import MatchConfig
from tallyloom.functions.likeness import token_set_score
from tallyloom.functions.lineage import settled
from tallyloom.functions.rows import row_key
from tallyloom.functions.text import clean_name, json_fields, significant_tokens
from tallyloom.operators.reference import context_terms, exact_lookup, raw_names, reference_countries, token_index


def exact_matches(names: DataFrame, lookup: DataFrame) -> DataFrame:
    """name, ref, score, mtype and notes of the names that are a reference or an alias."""
    return names.join(lookup, "name").select("name", "ref", F.lit(100.0).alias("score"), F.lit("exact").alias("mtype"), "notes")


def candidate_pairs(names: DataFrame, index: DataFrame) -> DataFrame:
    """Distinct pairs of a name and a reference that share a significant token."""
    tokens = names.select("name", F.explode(significant_tokens(F.col("name"))).alias("token"))
    return tokens.join(index, "token").select("name", "ref").distinct()


def likely_matches(names: DataFrame, references: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """The best reference by likeness of each name, if it then stands the checks; the second best is never tried.

    Of equally like references the first in alphabetical order wins.
    """
    apt = names.filter(~F.col("name").isin(K.GENERIC_NAMES) & (F.length("name") > config.short_name_max_len) & ~F.col("name").isin(sorted(config.exact_only_names)))
    scored = candidate_pairs(apt, token_index(references)).withColumn("score", token_set_score("name", "ref")).filter(F.col("score") >= config.fuzzy_medium_threshold)
    best = scored.groupBy("name").agg(F.min(F.struct((-F.col("score")).alias("loss"), "ref")).alias("best"))
    won = best.select("name", F.col("best.ref").alias("ref"), (-F.col("best.loss")).alias("score"))
    own, other = significant_tokens(F.col("name")), significant_tokens(F.col("ref"))
    single = F.lit(False)
    if config.single_token_match_min_len > 0:
        single = (F.size(other) == 1) & (F.length("ref") >= config.single_token_match_min_len) & (F.size(F.array_except(other, own)) == 0)
    ratio = F.greatest(F.length("name"), F.length("ref")) / F.greatest(F.least(F.length("name"), F.length("ref")), F.lit(1))
    checked = won.withColumn("single", single).filter(F.col("single") | ((F.size(F.array_intersect(own, other)) >= config.token_overlap_min) & (ratio <= config.length_ratio_max)))
    for a, b in sorted(config.false_positive_pairs):
        checked = checked.filter(~(((F.col("ref") == a) & (F.col("name") == b)) | ((F.col("name") == a) & (F.col("ref") == b))))
    kind = F.when(F.col("single") | (F.col("score") < config.fuzzy_high_threshold), "fuzzy_medium").otherwise("fuzzy_high")
    return checked.select("name", "ref", "score", kind.alias("mtype"), F.when(F.col("single"), "single_token").otherwise("").alias("notes"))


def match_names(names: DataFrame, references: DataFrame, aliases: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """name, ref, score, mtype and notes for the distinct names (column name) that match."""
    distinct = names.select("name").filter("name IS NOT NULL AND name <> ''").distinct()
    exact = exact_matches(distinct, exact_lookup(references, aliases))
    return exact.unionByName(likely_matches(distinct.join(exact, "name", "left_anti"), references, config))


def text_hits(rows: DataFrame, key: str, text: Column, terms: DataFrame) -> DataFrame:
    """key, ref, is_alias of the first term in each clean text: the leftmost, of those at one place the longest.

    Clean texts and terms are words joined by single blanks, so a term is in a text if it is one of the text's runs of words. Only places whose word begins
    some term are looked at, and only up to the longest term that begins so.
    """
    heads = terms.groupBy(F.split("term", " ")[0].alias("head")).agg(F.max(F.size(F.split("term", " "))).alias("most"))
    words = rows.select(key, F.split(clean_name(text), " ").alias("words")).filter("words[0] <> ''").distinct()
    at = words.select(key, "words", F.posexplode("words").alias("at", "head")).join(heads, "head")
    runs = F.transform(F.sequence(F.lit(1), F.least("most", F.size("words") - F.col("at"))), lambda n: F.struct((-n).alias("less"), F.array_join(F.slice("words", F.col("at") + 1, n), " ").alias("term")))
    hits = at.select(key, "at", F.explode(runs).alias("r")).select(key, "at", "r.*").join(terms, "term")
    return hits.groupBy(key).agg(F.min(F.struct("at", "less", "ref", "is_alias")).alias("h")).select(key, "h.ref", "h.is_alias")


def match_awards(awards: DataFrame, references: DataFrame, aliases: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """The primary records of awards with the columns <prefix>_flag, _score, _type, _matched_on, _reference_name and _notes.

    By name first; records it leaves are looked at by description, then (loans of two banks) by title, then by fields of their original columns, then, if asked, by name
    as a text. A name match of medium likeness is dropped where the record's country is none of the reference's, a match against a beneficiary's known
    false pattern is vetoed; texts may still claim both.
    """
    prefix = config.output_prefix
    primary = awards.filter(F.lower(F.col("is_primary_record").cast("string")) == "true").withColumns({"_row": row_key(awards), "_name": F.coalesce(F.col("entity_name_clean").cast("string"), F.lit(""))})
    references = settled(references)  # small, and used by every layer
    by_name = settled(match_names(primary.select(F.col("_name").alias("name")), references, aliases, config))  # distinct names that match
    named = by_name.join(reference_countries(references), "ref", "left").select(F.col("name").alias("_name"), F.struct("ref", "score", "mtype", "notes", "countries").alias("_hit"))
    rows = primary.join(named, "_name", "left")
    country = F.upper(F.trim(F.coalesce(F.col("country"), F.lit(""))))
    strange = (F.col("_hit.mtype") == "fuzzy_medium") & (country != "") & (F.size("_hit.countries") > 0) & ~F.array_contains("_hit.countries", country)
    rows = rows.withColumn("_hit", F.when(F.col("_hit").isNotNull() & ~strange, F.col("_hit"))).withColumn("_vetoed", _vetoed(config))

    terms = settled(context_terms(references, aliases, config))
    searched = F.col("source").isin(sorted(config.layer_b_sources))
    open_rows = rows.filter(F.col("_hit").isNull() | F.col("_vetoed"))
    layers: list[tuple[DataFrame, float, float, str, str, str]] = [
        (open_rows.filter(searched).select("_row", F.col("description").alias("_text")), 95.0, 90.0, "contextual_exact", "description", "description"),
        (open_rows.filter(F.col("source").isin("EIB", "EBRD")).select("_row", F.col("entity_name_raw").alias("_text")), 92.0, 88.0, "eib_title_extraction", "entity_name_raw", "title"),
    ]
    fields = json_fields(F.col("original_columns"))
    for k in range(max([0, *map(len, config.source_context_fields.values())])):
        pick = reduce(lambda c, sf: F.when(F.col("source") == sf[0], F.try_element_at(fields, F.lit(sf[1][k]))).otherwise(c), ((s, f) for s, f in config.source_context_fields.items() if len(f) > k), F.lit(None).cast("string"))
        texts = open_rows.select("_row", pick.alias("_text")).filter(F.length("_text") >= 4)
        layers.append((texts, 95.0, 90.0, "contextual_exact", f"original_columns[{k}]", "field"))
    if config.context_scan_entity_name:
        layers.append((open_rows.select("_row", F.col("entity_name_raw").alias("_text")), 93.0, 90.0, "contextual_entity_name", "entity_name_raw", "entity_name"))
    found = [
        text_hits(texts, "_row", F.col("_text"), terms).select(
            "_row", F.struct(F.lit(i).alias("layer"), "ref", F.when(F.col("is_alias"), alias).otherwise(own).alias("score"), F.lit(kind).alias("mtype"),
            F.concat(F.when(F.col("is_alias"), "alias_").otherwise(""), F.lit(f"match_in_{where}")).alias("notes"), F.lit(on).alias("on")).alias("_text_hit"))
        for i, (texts, own, alias, kind, on, where) in enumerate(layers)
    ]
    first = reduce(DataFrame.unionByName, found).groupBy("_row").agg(F.min("_text_hit").alias("_text_hit"))
    merged = rows.join(first, "_row", "left")
    by_text, by_list = F.col("_text_hit").isNotNull(), F.col("_hit").isNotNull()
    pick = lambda field: F.when(by_text, F.col(f"_text_hit.{field}")).when(by_list, F.col(f"_hit.{field}"))
    out = merged.withColumns({
        "_ref": pick("ref"), f"{prefix}_flag": by_text | (by_list & ~F.col("_vetoed")), f"{prefix}_score": pick("score"),
        f"{prefix}_type": F.when(by_text, F.col("_text_hit.mtype")).when(by_list & F.col("_vetoed"), "vetoed_false_positive").when(by_list, F.col("_hit.mtype")).otherwise("none"),
        f"{prefix}_matched_on": F.when(by_text, F.col("_text_hit.on")).when(by_list, "entity_name").otherwise(""), f"{prefix}_notes": F.coalesce(pick("notes"), F.lit("")),
    })
    spelled = raw_names(references).select(F.col("ref").alias("_ref"), F.col("raw").alias("_raw"))
    named = out.join(spelled, "_ref", "left").withColumn(f"{prefix}_reference_name", F.coalesce("_raw", "_ref", F.lit("")))
    return named.drop("_row", "_name", "_hit", "_vetoed", "_text_hit", "_ref", "_raw")


def _vetoed(config: MatchConfig) -> Column:
    out = F.lit(False)
    beneficiary, ref = F.coalesce(F.col("beneficiary_name"), F.lit("")), F.col("_hit.ref")
    for name, pattern in sorted(config.beneficiary_fp_patterns.items()):
        out = out | (((ref == name) | ref.startswith(name + " ")) & beneficiary.rlike(pattern))
    return F.coalesce(out, F.lit(False))


def match_log(matched: DataFrame, prefix: str = "match") -> DataFrame:
    """The matched records, in the columns that later stages need (with beneficiary_name, description, programme, fund and grant amounts, which they also use)."""
    columns = ["source", "source_record_id", "year", "country", "amount_eur", "amount_gge_eur", "financial_instrument_class", "flow_stage_group", "fiscal_source_type", "entity_name_raw", "entity_name_clean", "beneficiary_name", "description", "programme", "fund"]
    own = [f"{prefix}_{x}" for x in ("reference_name", "score", "type", "matched_on", "notes")]
    return matched.filter(F.col(f"{prefix}_flag")).select(*(c for c in columns if c in matched.columns), *own)


def match_summary(matched: DataFrame, prefix: str = "match") -> dict[str, DataFrame]:
    """Counts and sums of the matched records by type, by source, and for the 20 largest references."""
    rows = matched.filter(F.col(f"{prefix}_flag"))
    sums = [F.count("*").alias("rows"), F.coalesce(F.sum("amount_eur"), F.lit(0.0)).alias("total_eur")]
    by = lambda c: rows.filter(F.col(c).isNotNull()).groupBy(c).agg(*sums).orderBy(F.desc("total_eur"), c)
    return {"by_type": by(f"{prefix}_type"), "by_source": by("source"), "top_references": by(f"{prefix}_reference_name").limit(20)}

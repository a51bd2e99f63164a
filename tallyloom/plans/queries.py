"""Queries over the star schema for each operator, with their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import constants as K
from tallyloom.config import Keywords, MatchConfig
from tallyloom.functions.amounts import allowance_price, country_block, match_probability, relative_difference
from tallyloom.functions.text import case_code, clean_name, clean_plain, grant_id, has, json_fields, phrase_pattern, significant_tokens, with_flag
from tallyloom.operators import cases, consolidation, duplicates, enrichment, evidence, matching, reference, tables
from tallyloom.plans.awards import AWARDS_SQL, awards, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
REF = "match_reference_name"
MONEY = "CAST(sum(CAST(amount_eur AS DECIMAL(20,2))) AS DOUBLE)"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql if "FROM awards" not in sql or sql.lstrip().startswith("WITH awards") else f"WITH {AWARDS_SQL}{sql}"
        return f

    return add


def _by(keys: str, entities: bool = True) -> str:
    more = f", count(DISTINCT {REF}) AS entities" if entities else ""
    return f" SELECT {keys}, {MONEY} AS total_eur, count(amount_eur) AS rows{more} FROM awards GROUP BY {keys}"


# --- tables and measures ------------------------------------------------------------------------------------


@query(_by("source"))
def t1_by_source(spark, d):
    return tables.breakdown(awards(spark, d), ["source"], REF)


@query(_by("country"))
def t2_by_country(spark, d):
    return tables.breakdown(awards(spark, d), ["country"], REF)


@query(_by("financial_instrument_class", False))
def t3_by_instrument(spark, d):
    return tables.breakdown(awards(spark, d), ["financial_instrument_class"])


@query(_by("year"))
def t4_by_year(spark, d):
    return tables.breakdown(awards(spark, d), ["year"], REF, order_by_key=True)


@query(_by("fiscal_source_type", False))
def t5_by_fiscal_source(spark, d):
    return tables.breakdown(awards(spark, d), ["fiscal_source_type"])


@query(f" SELECT {REF}, {MONEY} AS total_eur, count(amount_eur) AS rows, count(DISTINCT source) AS sources, count(DISTINCT country) AS countries FROM awards GROUP BY {REF} ORDER BY total_eur DESC, {REF} LIMIT 30")
def t6_top_entities(spark, d):
    return tables.top_entities(awards(spark, d), REF)


@query(_by("year, financial_instrument_class", False))
def t7_year_instrument(spark, d):
    return tables.breakdown(awards(spark, d), ["year", "financial_instrument_class"], order_by_key=True)


@query(f" SELECT CASE WHEN year < 1998 THEN 'pre_1998' ELSE 'post_1998' END AS period, {MONEY} AS total_eur, count(amount_eur) AS rows FROM awards GROUP BY 1")
def t8_period_shift(spark, d):
    return tables.period_shift(awards(spark, d), 1998)


_GGE = "amount_eur * CASE financial_instrument_class WHEN 'grant' THEN 1.0 WHEN 'loan' THEN 0.15 WHEN 'guarantee' THEN 0.1 WHEN 'Tax advantage' THEN 0.15 WHEN 'mixed' THEN 0.5 END"


@query(
    f" SELECT parent_group, count(DISTINCT {REF}) AS n_entities, count(amount_eur) AS n_rows, {MONEY} AS total_eur, CAST(sum(CAST(amount_eur AS DECIMAL(20,2))) AS DOUBLE) AS total_gge,"
    " count(DISTINCT country) AS n_countries, count(DISTINCT source) AS n_sources FROM awards GROUP BY parent_group"
)
def tg1_groups(spark, d):
    rows = awards(spark, d).withColumns({"dc_preferred": F.lit(True), "amount_gge": F.col("amount_eur")})
    return tables.group_ranking(rows, REF)


def _pivot_sql(across: str, values: list[str]) -> str:
    cells = [f"CAST(coalesce(sum(CASE WHEN {across} = '{v}' THEN CAST(amount_eur AS DECIMAL(20,2)) END), 0) AS DOUBLE) AS \"{v}\"" for v in values]
    return f" SELECT parent_group, {', '.join(cells)}, {MONEY} AS \"TOTAL\" FROM awards GROUP BY parent_group"


@query(_pivot_sql("source", ["FTS", "IPCEI_state_aid", "KOHESIO", "RRF", "TAM"]))
def tg2_group_source(spark, d):
    return tables.pivot(awards(spark, d), "parent_group", "source")


@query(_pivot_sql("financial_instrument_class", ["Tax advantage", "grant", "guarantee", "loan", "mixed"]))
def tg3_group_instrument(spark, d):
    return tables.pivot(awards(spark, d), "parent_group", "financial_instrument_class")


#: The nations of the test tables, which become columns.
NATIONS = ["NATION_0", "NATION_1", "NATION_10", "NATION_11", "NATION_12", "NATION_13", "NATION_14", "NATION_15", "NATION_16", "NATION_17", "NATION_18", "NATION_19", "NATION_2", "NATION_20", "NATION_21", "NATION_22", "NATION_23", "NATION_24", "NATION_3", "NATION_4", "NATION_5", "NATION_6", "NATION_7", "NATION_8", "NATION_9"]


@query(_pivot_sql("country", NATIONS))
def tg4_group_country(spark, d):
    return tables.pivot(awards(spark, d), "parent_group", "country")


_SHARES = f""", sums AS (SELECT {{by}} AS name, CAST(sum(CAST(amount_eur AS DECIMAL(20,2))) AS DOUBLE) AS money FROM awards GROUP BY {{by}}),
ranked AS (SELECT name, money, row_number() OVER (ORDER BY money DESC, name) AS rank, sum(money) OVER () AS total, count(*) OVER () AS n FROM sums)
SELECT CAST(max(n) AS BIGINT) AS count, round(max(total), 2) AS total_eur, round(sum((money / total) * (money / total)) * 10000, 6) AS hhi,
  round(sum(CASE WHEN rank <= 1 THEN money / total ELSE 0 END) * 100, 6) AS top1_pct, round(CASE WHEN max(n) >= 5 THEN sum(CASE WHEN rank <= 5 THEN money / total ELSE 0 END) * 100 ELSE 0 END, 6) AS top5_pct,
  round(CASE WHEN max(n) >= 10 THEN sum(CASE WHEN rank <= 10 THEN money / total ELSE 0 END) * 100 ELSE 0 END, 6) AS top10_pct,
  round(CASE WHEN max(n) >= 20 THEN sum(CASE WHEN rank <= 20 THEN money / total ELSE 0 END) * 100 ELSE 0 END, 6) AS top20_pct,
  round(1 - 2 * sum(rank * money / total) / max(n), 6) AS gini, max(CASE WHEN rank = 1 THEN name END) AS top1_name
FROM ranked"""


def _concentration(spark, d, by):
    out = tables.concentration(awards(spark, d), by)
    return out.select("count", F.round("total_eur", 2).alias("total_eur"), *(F.round(c, 6).alias(c) for c in ("hhi", "top1_pct", "top5_pct", "top10_pct", "top20_pct", "gini")), "top1_name")


@query(_SHARES.format(by=REF))
def concentration_entities(spark, d):
    return _concentration(spark, d, REF)


@query(_SHARES.format(by="parent_group"))
def concentration_groups(spark, d):
    return _concentration(spark, d, "parent_group")


@query(
    f""", best AS (SELECT {REF} AS name, {MONEY} AS eur FROM awards GROUP BY {REF} ORDER BY eur DESC, name DESC LIMIT 1)
SELECT {MONEY} AS total_face_eur, count(*) AS n_relations, count(DISTINCT {REF}) AS n_beneficiaries, min(year) AS year_min, max(year) AS year_max, (SELECT name FROM best) AS top_beneficiary, (SELECT eur FROM best) AS top_beneficiary_eur FROM awards"""
)
def headline(spark, d):
    return tables.headline(awards(spark, d), REF).drop("total_gge_eur")


@query(f" SELECT country, {MONEY} AS total_eur FROM awards GROUP BY country ORDER BY total_eur DESC, country LIMIT 15")
def chart_countries(spark, d):
    return tables.ranked_bars(tables.breakdown(awards(spark, d), ["country"]), "country")


@query(f" SELECT year, {MONEY} AS total_eur FROM awards GROUP BY year")
def chart_years(spark, d):
    return tables.year_bars(tables.breakdown(awards(spark, d), ["year"]))


# --- names and texts ----------------------------------------------------------------------------------------

_FORMS = "regexp_replace(lower(coalesce({c}, '')), '\\b(?:" + "|".join(K.LEGAL_FORMS).replace("{", "{{").replace("}", "}}") + ")\\b\\.?', ' ', 'g')"
_CLEAN = "trim(regexp_replace(regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"


@query(f"SELECT c_custkey, {_CLEAN.format(c='c_name')} AS clean_name, {_CLEAN.format(c='c_name')} AS clean_plain FROM customer")
def clean_names(spark, d):
    return table(spark, d, "customer").select("c_custkey", clean_name(F.col("c_name")).alias("clean_name"), clean_plain(F.col("c_name")).alias("clean_plain"))


@query("SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS token FROM part")
def significant_words(spark, d):
    return table(spark, d, "part").select("p_partkey", F.explode(significant_tokens(clean_name(F.col("p_name")))).alias("token"))


@query("SELECT o_orderkey, o_custkey AS grant_id, 'SA.' || CAST(o_orderkey AS VARCHAR) AS case_code FROM orders WHERE o_custkey >= 10000 OR o_custkey < 10000")
def codes(spark, d):
    said = F.concat(F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit(" - ACR - Title"))
    return table(spark, d, "orders").select("o_orderkey", grant_id(said).alias("grant_id"), case_code(F.concat(F.lit("SA."), F.col("o_orderkey").cast("string"), F.lit("(2018/X)"))).alias("case_code"))


def _references(spark, d):
    listed = table(spark, d, "part").select(F.col("p_name").alias("company_name")).distinct()
    return reference.reference_list(listed, reference.alias_table(spark, []))


@query("SELECT p_partkey, name AS ref, 100.0::DOUBLE AS score, 'exact' AS mtype FROM part JOIN (SELECT DISTINCT p_name AS name FROM part) r ON p_name = name")
def exact_matching(spark, d):
    names = table(spark, d, "part").select("p_partkey", clean_name(F.col("p_name")).alias("name"))
    found = matching.exact_matches(names.select("name").distinct(), reference.exact_lookup(_references(spark, d), reference.alias_table(spark, [])))
    return names.join(found, "name").select("p_partkey", "ref", "score", "mtype")


@query(
    """WITH tokens AS (SELECT DISTINCT p_name AS name, unnest(string_split(p_name, ' ')) AS token FROM part)
SELECT DISTINCT a.name, b.name AS ref FROM tokens a JOIN tokens b ON a.token = b.token"""
)
def token_blocking(spark, d):
    names = table(spark, d, "part").select(clean_name(F.col("p_name")).alias("name")).distinct()
    return matching.candidate_pairs(names, reference.token_index(_references(spark, d)))


@query()
def fuzzy_matching(spark, d):
    """Likeness has no SQL: tests hold the scorer against cases worked out by hand."""
    names = table(spark, d, "supplier").select(F.concat(F.lit("Blue widget works "), F.col("s_name"), F.lit(" GmbH")).alias("raw")).select(clean_name(F.col("raw")).alias("name"))
    parts = table(spark, d, "part").select(F.concat(F.col("p_name"), F.lit(" and gear")).alias("raw")).select(clean_name(F.col("raw")).alias("name"))
    return matching.match_names(names.unionByName(parts), _references(spark, d), reference.alias_table(spark, []), MatchConfig(token_overlap_min=1))


_TERMS = "SELECT DISTINCT lower(regexp_extract(text, '^([A-Za-z]+ [a-z]+ [a-z]+)', 1)) AS term FROM benchmark WHERE regexp_matches(text, '^[A-Za-z]+ [a-z]+ [a-z]+ ')"


@query(
    f"""WITH terms AS ({_TERMS}), docs AS (SELECT doc_id, ' ' || {_CLEAN.replace('[^a-z0-9 ]', '[^a-z0-9]').format(c=_FORMS.format(c='text'))} || ' ' AS t FROM documents WHERE lang = 'en' AND NOT regexp_matches(text, '[^\\x00-\\x7F(){{}}]') AND strpos(text, '(') = 0),
hits AS (SELECT doc_id, term, strpos(t, ' ' || term || ' ') AS place FROM docs JOIN terms ON strpos(t, ' ' || term || ' ') > 0),
ranked AS (SELECT doc_id, term AS ref, row_number() OVER (PARTITION BY doc_id ORDER BY place, length(term) DESC) AS k FROM hits)
SELECT doc_id, ref FROM ranked WHERE k = 1"""
)
def text_matching(spark, d):
    first = F.lower(F.regexp_extract("text", "^([A-Za-z]+ [a-z]+ [a-z]+)", 1)).alias("term")
    terms = table(spark, d, "benchmark").filter(F.col("text").rlike("^[A-Za-z]+ [a-z]+ [a-z]+ ")).select(first).distinct().select("term", F.col("term").alias("ref"), F.lit(False).alias("is_alias"))
    docs = table(spark, d, "documents").filter((F.col("lang") == "en") & ~F.col("text").rlike(r"[^\x00-\x7F(){}]") & ~F.col("text").contains("("))
    return matching.text_hits(docs, "doc_id", F.col("text"), terms).select("doc_id", "ref")


@query(
    """SELECT doc_id, CASE WHEN c AND (s OR n) THEN 'very_high' WHEN c OR (s AND n) THEN 'high' WHEN s OR (m AND n) THEN 'medium' WHEN n THEN 'low_nace_only' WHEN m THEN 'low_keyword_only' ELSE 'none' END AS match_probability
FROM (SELECT doc_id, regexp_matches(lower(text), 'license|copyright') AS s, regexp_matches(lower(text), 'that|dans') AS m, strpos(lower(text), 'released under') > 0 AS c, source = 'src1' AS n FROM documents) x"""
)
def probability_ladder(spark, d):
    docs = table(spark, d, "documents")
    found = match_probability(F.lower("text").contains("released under"), has(F.col("text"), "(?i)license|copyright"), has(F.col("text"), "(?i)that|dans"), F.col("source") == "src1")
    return docs.select("doc_id", found.alias("match_probability"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_values(spark, d):
    return table(spark, d, "events").select("event_id", F.try_element_at(json_fields(F.col("props")), F.lit("k")).alias("k"))


# --- what registers repeat ----------------------------------------------------------------------------------


def _marked(spark, d):
    return duplicates.with_marks(awards(spark, d))


_PAIRS = """, a AS (SELECT * FROM awards WHERE source = 'TAM'), b AS (SELECT * FROM awards WHERE source = '{other}'),
pairs AS (SELECT a.source_record_id AS id FROM a JOIN b ON a.match_reference_name = b.match_reference_name AND a.country = b.country AND abs(a.year - b.year) <= 2 AND {fits})
SELECT id, count(*) AS pairs FROM pairs GROUP BY id /* FROM awards */"""


@query(_PAIRS.format(other="KOHESIO", fits="b.amount_eur / a.amount_eur BETWEEN 0.01 AND 1.5"))
def cofinancing_pairs(spark, d):
    return duplicates.cofinancing_pairs(awards(spark, d), "KOHESIO").groupBy(F.col("id_a").alias("id")).agg(F.count("*").alias("pairs"))


_MARKED = """, a AS (SELECT * FROM awards WHERE source = 'TAM'),
koh AS (SELECT DISTINCT a.source_record_id AS id FROM a JOIN awards b ON b.source = 'KOHESIO' AND a.match_reference_name = b.match_reference_name AND a.country = b.country AND abs(a.year - b.year) <= 2 AND b.amount_eur / a.amount_eur BETWEEN 0.01 AND 1.5),
rrf AS (SELECT DISTINCT a.source_record_id AS id FROM a JOIN awards b ON b.source = 'RRF' AND a.match_reference_name = b.match_reference_name AND a.country = b.country AND abs(a.year - b.year) <= 2 AND b.amount_eur / a.amount_eur BETWEEN 0.01 AND 1.5),
ipc AS (SELECT DISTINCT a.source_record_id AS id FROM a JOIN awards b ON b.source = 'IPCEI_state_aid' AND a.match_reference_name = b.match_reference_name AND a.country = b.country AND abs(a.year - b.year) <= 2
  AND abs(a.amount_eur - b.amount_eur) / greatest(a.amount_eur, b.amount_eur) <= 0.2),
flagged AS (SELECT w.source, w.amount_eur, concat_ws('|', CASE WHEN koh.id IS NOT NULL AND w.source = 'TAM' THEN 'cofinancing_overlap:tam_kohesio' END, CASE WHEN rrf.id IS NOT NULL AND w.source = 'TAM' THEN 'cofinancing_overlap:tam_rrf' END,
  CASE WHEN ipc.id IS NOT NULL AND w.source = 'TAM' THEN 'confirmed_duplicate:ipcei_tam' END) AS dc_flag
  FROM awards w LEFT JOIN koh ON w.source_record_id = koh.id LEFT JOIN rrf ON w.source_record_id = rrf.id LEFT JOIN ipc ON w.source_record_id = ipc.id)
SELECT source, dc_flag, dc_flag = '' AS dc_preferred, count(*) AS rows, CAST(sum(CAST(amount_eur AS DECIMAL(20,2))) AS DOUBLE) AS total_eur FROM flagged GROUP BY source, dc_flag"""


@query(_MARKED)
def duplicate_marks(spark, d):
    rows = duplicates.mark_listed_projects(duplicates.mark_cofinancing(_marked(spark, d)))
    return rows.groupBy("source", "dc_flag", "dc_preferred").agg(F.count("*").alias("rows"), tables.total("amount_eur", "total_eur"))


@query(""", ranked AS (SELECT source, row_number() OVER (PARTITION BY source_record_id, entity_name_clean, amount_eur, year ORDER BY ord) AS k FROM awards WHERE amount_eur > 0)
SELECT source, k > 1 AS again, count(*) AS rows FROM ranked GROUP BY source, k > 1""")
def multicountry_marks(spark, d):
    return duplicates.mark_multicountry(_marked(spark, d)).groupBy("source", (F.col("dc_flag") == "same_record_multicountry").alias("again")).agg(F.count("*").alias("rows"))


@query(" SELECT DISTINCT source, source_record_id, entity_name_clean, amount_eur, year, country FROM awards")
def exact_repeats(spark, d):
    return duplicates.drop_exact_repeats(awards(spark, d)).select("source", "source_record_id", "entity_name_clean", "amount_eur", "year", "country")


@query(f" SELECT source_record_id, ord, amount_eur, round({_GGE}, 6) AS amount_gge FROM awards")
def grant_equivalents(spark, d):
    return consolidation.add_grant_equivalent(awards(spark, d)).select("source_record_id", "ord", "amount_eur", F.round("amount_gge", 6).alias("amount_gge"))


@query(
    """WITH members AS (SELECT * FROM (VALUES ('Round', 'ring', 0), ('Round', 'washer', 1), ('Flat', 'small', 2), ('Flat', 'small ring', 3), ('Colour', 'red', 4)) AS m(grp, member, ord)),
fits AS (SELECT n.p_name AS name, grp, row_number() OVER (PARTITION BY n.p_name ORDER BY length(member) DESC, ord) AS k FROM (SELECT DISTINCT p_name FROM part) n JOIN members ON strpos(n.p_name, member) > 0 OR strpos(member, n.p_name) > 0)
SELECT n.p_name AS name, coalesce(f.grp, n.p_name) AS parent_group FROM (SELECT DISTINCT p_name FROM part) n LEFT JOIN fits f ON f.name = n.p_name AND f.k = 1"""
)
def parent_group_lookup(spark, d):
    members = consolidation.group_members(spark, {"Round": ["ring", "washer"], "Flat": ["small", "small ring"], "Colour": ["red"]})
    return consolidation.parent_groups(table(spark, d, "part"), members, "p_name")


@query("SELECT n_nationkey, CASE WHEN iso IN ('DE', 'FR') THEN 'EU' WHEN iso IN ('CN', 'HK') THEN 'CN' WHEN iso = 'US' THEN 'US' WHEN iso = '' THEN 'Unknown' ELSE 'Other' END AS block FROM (SELECT n_nationkey, CASE n_nationkey % 7 WHEN 0 THEN 'DE' WHEN 1 THEN 'FR' WHEN 2 THEN 'CN' WHEN 3 THEN 'HK' WHEN 4 THEN 'US' WHEN 5 THEN 'BR' ELSE '' END AS iso FROM nation) x")
def origin_blocks(spark, d):
    iso = F.element_at(F.array(*map(F.lit, ["de", "FR ", "CN", "HK", "US", "BR", ""])), (F.col("n_nationkey") % 7 + 1).cast("int"))
    return table(spark, d, "nation").select("n_nationkey", country_block(iso).alias("block"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, o_totalprice, round(abs(l_extendedprice - o_totalprice) / greatest(abs(l_extendedprice), abs(o_totalprice)), 9) AS difference FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def relative_differences(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice", "o_totalprice", F.round(relative_difference(F.col("l_extendedprice"), F.col("o_totalprice")), 9).alias("difference"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'new' ELSE concat(o_orderstatus, '|new') END AS flags FROM orders")
def flag_lists(spark, d):
    return table(spark, d, "orders").select("o_orderkey", with_flag(F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")), "new").alias("flags"))


# --- enrichment ---------------------------------------------------------------------------------------------


@query(
    """SELECT l_orderkey AS project_id, string_agg(DISTINCT s_name, '|' ORDER BY s_name) AS company_names, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS company_countries, count(DISTINCT s_name) AS n_companies,
  CAST(sum(l_linenumber) AS DOUBLE) AS total_company_ec FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_returnflag = 'R' GROUP BY l_orderkey"""
)
def project_companies(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    participants = rows.select(F.col("l_orderkey").alias("project_id"), F.when(F.col("l_returnflag") == "R", "PRC").otherwise("HES").alias("activity_type"), F.col("s_name").alias("org_name"), F.col("n_name").alias("org_country"), F.col("l_linenumber").cast("double").alias("ec_contribution"))
    return enrichment.project_companies(participants)


_PRICES = "CASE CAST(year(o_orderdate) AS INTEGER) + 15 " + " ".join(f"WHEN {y} THEN {p}" for y, p in K.ALLOWANCE_PRICES.items()) + f" ELSE {K.OTHER_YEARS_PRICE} END"
_ALLOCATED = f"SELECT c_name AS company, CAST(c_custkey AS VARCHAR) AS installation_id, n_name AS registry_id, CAST(year(o_orderdate) AS INTEGER) + 15 AS year, floor(o_totalprice) AS allocated, {_PRICES} AS price FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"


def _allocations(spark, d):
    installations = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("n_name").alias("registry_id"), F.lit("24.10").alias("nace_id"), F.lit("x").alias("city")
    )
    amount = F.floor("o_totalprice").cast("double")
    compliance = table(spark, d, "orders").select(F.col("o_custkey").alias("installation_id"), (F.year("o_orderdate") + 15).alias("year"), amount.alias("allocatedFree"), amount.alias("allocatedTotal"), amount.alias("verified"))
    return enrichment.allocations(enrichment.matching_installations(installations, phrase_pattern([]), "24"), compliance)


@query(f"SELECT company, year, count(DISTINCT installation_id) AS installations, count(DISTINCT registry_id) AS countries, sum(allocated) AS free_allowances, sum(allocated * price) AS eur_free FROM ({_ALLOCATED}) x GROUP BY company, year")
def allocations_by_company_year(spark, d):
    return enrichment.allocations_by_company_year(_allocations(spark, d)).select("company", "year", "installations", "countries", "free_allowances", "eur_free")


@query(f"SELECT company, count(DISTINCT installation_id) AS installations, string_agg(DISTINCT registry_id, ',' ORDER BY registry_id) AS countries, min(year) AS first_year, max(year) AS last_year, sum(allocated) AS total_free_allowances, sum(allocated * price) AS total_eur_free FROM ({_ALLOCATED}) x GROUP BY company")
def allocations_by_company(spark, d):
    return enrichment.allocations_by_company(_allocations(spark, d)).drop("total_verified_emissions")


@query("SELECT o_orderkey, CAST(" + _PRICES + " AS DOUBLE) AS price FROM orders")
def allowance_prices(spark, d):
    return table(spark, d, "orders").select("o_orderkey", allowance_price(F.year("o_orderdate") + 15).alias("price"))


@query(""", known AS (SELECT DISTINCT source, source_record_id FROM awards WHERE amount_eur > 50000)
SELECT w.source, count(*) AS rows, CAST(sum(CAST(w.amount_eur AS DECIMAL(20,2))) AS DOUBLE) AS total_eur FROM awards w LEFT JOIN known k ON w.source = k.source AND w.source_record_id = k.source_record_id WHERE k.source IS NULL GROUP BY w.source""")
def unmatched_by_source(spark, d):
    rows = awards(spark, d)
    return enrichment.unmatched(rows, rows.filter("amount_eur > 50000")).groupBy("source").agg(F.count("*").alias("rows"), tables.total("amount_eur", "total_eur"))


@query(" SELECT source, source_record_id, amount_eur FROM awards WHERE source = 'FTS' AND source_record_id NOT IN (SELECT source_record_id FROM awards WHERE source = 'FTS' AND amount_eur > 90000)")
def new_records(spark, d):
    rows = awards(spark, d)
    return consolidation.new_records(rows.filter("source = 'FTS'"), rows.filter("amount_eur > 90000"), "FTS").select("source", "source_record_id", "amount_eur")


@query(" SELECT source, source_record_id, amount_eur FROM awards WHERE amount_eur > 60000 ORDER BY amount_eur DESC, source, source_record_id LIMIT 500")
def largest_awards(spark, d):
    return enrichment.largest(awards(spark, d), 60_000).select("source", "source_record_id", "amount_eur")


@query(" SELECT source, count(*) AS rows, round(sum(amount_eur), 2) AS total_eur, count(*) FILTER (amount_eur > 50000) AS high_value_rows, round(sum(CASE WHEN amount_eur > 50000 THEN amount_eur ELSE 0 END), 2) AS high_value_eur FROM awards GROUP BY source")
def unmatched_statistics(spark, d):
    rows = enrichment.unmatched_statistics(awards(spark, d), 50_000)
    return rows.withColumns({c: F.round(c, 2) for c in ("total_eur", "high_value_eur")})


@query(", c AS (SELECT * FROM awards WHERE amount_eur > 80000) SELECT beneficiary_name AS matched_company, count(amount_eur) AS rows, round(sum(amount_eur), 2) AS total_eur FROM c GROUP BY 1 /* FROM awards */")
def company_statistics(spark, d):
    rows = awards(spark, d).filter("amount_eur > 80000").withColumn("matched_company", F.col("beneficiary_name"))
    return enrichment.company_statistics(rows).withColumn("total_eur", F.round("total_eur", 2))


@query(
    """, p AS (SELECT *, source_record_id IN (SELECT source_record_id FROM awards WHERE source = 'FTS' AND amount_eur > 90000) AS known FROM awards WHERE source = 'FTS')
SELECT count(*) AS rows, round(sum(amount_eur), 2) AS total_eur, count(*) FILTER (NOT known) AS unmatched_rows, round(sum(CASE WHEN known THEN 0 ELSE amount_eur END), 2) AS unmatched_eur, count(*) FILTER (known) AS matched_rows FROM p /* FROM awards */"""
)
def scan_totals(spark, d):
    rows = awards(spark, d).filter("source = 'FTS'")
    out = enrichment.scan_totals(rows, rows.filter("amount_eur > 90000"))
    return out.select("rows", F.round("total_eur", 2).alias("total_eur"), "unmatched_rows", F.round("unmatched_eur", 2).alias("unmatched_eur"), "matched_rows")


@query("SELECT o_orderkey, 'SA.' || CAST(o_orderkey AS VARCHAR) AS sa_code FROM orders WHERE o_orderpriority = '1-URGENT' UNION ALL SELECT o_orderkey, '' FROM orders WHERE o_orderpriority <> '1-URGENT'")
def case_codes_of_rows(spark, d):
    source = F.when(F.col("o_orderpriority") == "1-URGENT", "TAM").otherwise("FTS")
    rows = table(spark, d, "orders").select("o_orderkey", source.alias("source"), F.concat(F.lit("SA."), F.col("o_orderkey").cast("string"), F.lit("(2018/X)")).alias("source_record_id"))
    return cases.with_case_code(rows).select("o_orderkey", "sa_code")


@query("SELECT DISTINCT 'SA.' || CAST(o_orderkey AS VARCHAR) AS sa_code FROM orders WHERE o_totalprice <= 100000")
def unresolved_codes(spark, d):
    orders = table(spark, d, "orders").withColumn("sa_code", F.concat(F.lit("SA."), F.col("o_orderkey").cast("string")))
    return cases.unresolved(orders.select("sa_code"), orders.filter("o_totalprice > 100000").select(F.col("sa_code").alias("code")))


@query(
    """WITH spent AS (SELECT l_orderkey AS k, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(sum(l_linenumber) AS DOUBLE) * 20000 AS eur FROM lineitem GROUP BY 1, 2)
SELECT o_orderkey, CASE WHEN eur IS NULL OR eur <= 0 THEN 'no_data' WHEN o_totalprice / eur <= 1 THEN 'confirmed' WHEN o_totalprice / eur <= 2 THEN 'plausible' ELSE 'inconsistent' END AS amount_check
FROM orders LEFT JOIN spent ON k = o_orderkey AND y = year(o_orderdate)"""
)
def amount_checks(spark, d):
    spent = table(spark, d, "lineitem").groupBy(F.concat(F.lit("SA."), F.col("l_orderkey").cast("string")).alias("code"), F.year("l_shipdate").alias("year")).agg((F.sum("l_linenumber").cast("double") * 20000).alias("eur"))
    rows = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("SA."), F.col("o_orderkey").cast("string")).alias("sa_code"), F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("amount_eur"))
    return cases.amount_check(rows, spent).select("o_orderkey", "amount_check")


@query(" SELECT match_type, count(*) AS rows, round(sum(amount_eur), 2) AS total_eur FROM (SELECT amount_eur, CASE WHEN year < 1995 THEN 'exact' ELSE 'fuzzy_high' END AS match_type FROM awards WHERE amount_eur > 10000) x GROUP BY match_type")
def match_summary_by_type(spark, d):
    rows = awards(spark, d).withColumns({"match_flag": F.col("amount_eur") > 10000, "match_type": F.when(F.col("year") < 1995, "exact").otherwise("fuzzy_high")})
    return matching.match_summary(rows)["by_type"].withColumn("total_eur", F.round("total_eur", 2))


@query("SELECT event_type, count(*) AS rows FROM events GROUP BY event_type")
def value_counts(spark, d):
    return enrichment.value_counts(table(spark, d, "events"), "event_type")


@query(
    """WITH names AS (SELECT * FROM (VALUES ('red widget', 0), ('ring', 1), ('large blue gear', 2)) AS n(name, ord)),
fits AS (SELECT p_partkey, n.name, row_number() OVER (PARTITION BY p_partkey ORDER BY n.ord) AS k FROM part JOIN names n ON strpos(p_name, n.name) > 0 OR strpos(n.name, p_name) > 0
  OR (strpos(' ' || n.name || ' ', ' ' || split_part(p_name, ' ', 1) || ' ') > 0 AND strpos(' ' || n.name || ' ', ' ' || split_part(p_name, ' ', 2) || ' ') > 0))
SELECT p_partkey, name AS matched_company FROM fits WHERE k = 1"""
)
def listed_participants(spark, d):
    names = spark.createDataFrame([("red widget", 0), ("ring", 1), ("large blue gear", 2)], "name string, ord int")
    return enrichment.listed_participants(table(spark, d, "part").select("p_partkey", F.col("p_name").alias("company")), names).select("p_partkey", "matched_company")


@query()
def keyword_mining(spark, d):
    rows = awards(spark, d).withColumn("original_columns", F.lit('{"Subject": "gear works"}'))
    return enrichment.keyword_hits(rows.filter("source = 'FTS'"), Keywords(("red \\w+",), ("gear",)))


@query()
def forensic_ladder(spark, d):
    rows = awards(spark, d).withColumns({"original_columns": F.lit("{}"), "nace_2digit": F.lit("24")})
    return enrichment.forensics(rows, phrase_pattern(["customer#000000007"]), Keywords(("red \\w+",), ("ring",)), "24", 50_000)


@query()
def text_evidence(spark, d):
    """Evidence needs places in texts, which SQL regular expressions of both engines don't give alike; tests hold it against worked cases."""
    rows = table(spark, d, "documents").select("doc_id", evidence.evidence_column(F.concat(F.col("text"), F.lit(" The measure is co-financed by the ERDF and ESF."))).alias("e"))
    return rows.select("doc_id", "e.funds", "e.level")


@query()
def technology_scan(spark, d):
    return table(spark, d, "documents").select("doc_id", evidence.technology_column(F.col("text")).alias("t")).select("doc_id", "t.primary_tech", "t.techs_found")


@query()
def consolidated(spark, d):
    """The whole consolidation, in its order."""
    from tallyloom.plans.run import consolidate

    rows = awards(spark, d).drop("fiscal_source_type", "parent_group", "description", "is_primary_record")  # no rule and no column of the result asks for these
    rows = rows.withColumns({"match_type": F.lit("exact"), "match_matched_on": F.lit("entity_name"), "match_quality": F.lit("confirmed")})
    return consolidate(rows).select("source", "source_record_id", "amount_eur", "amount_gge", "dc_preferred", "dc_flag", "cofinancing_partner_id", "attribution_type", "match_quality")

"""State-aid cases: a nested document by case code, whose lists hold JSON in strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import case_code

_LISTS = ["caseTitle", "caseOriginalTitle", "caseMemberState", "caseExpenditures", "caseObjectives", "caseSectors", "caseAidInstruments", "caseLinks", "caseLastDecisionDate"]
_TEXTS = "array<string>"
CASE = (
    f"struct<metadata: struct<{', '.join(f'{x}: {_TEXTS}' for x in _LISTS)}>, decisions: array<struct<metadata: struct<metadataReference: {_TEXTS}>, "
    f"decisionAttachments: array<struct<metadata: struct<attachmentLink: {_TEXTS}, attachmentLanguage: {_TEXTS}, attachmentName: {_TEXTS}, attachmentSentDate: {_TEXTS}>>>>>>"
)


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """code and case of each entry of a JSON document that maps codes to cases. The document is parsed with a given type; its keys never become columns."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", f"map<string, {CASE}>")).alias("code", "case"))


def _list(name: str) -> Column:
    return F.coalesce(F.col(f"case.metadata.{name}"), F.array().cast(_TEXTS))


def _first(texts: Column) -> Column:
    return F.coalesce(F.get(texts, F.lit(0)), F.lit(""))


def interest_projects(cases: DataFrame) -> DataFrame:
    """Cases whose title, in any language, names a project of common interest."""
    titles = F.concat(_list("caseTitle"), _list("caseOriginalTitle"))
    state = F.get(_list("caseMemberState"), F.lit(0))
    return cases.filter(F.exists(titles, lambda t: F.lower(t).contains("ipcei"))).select(
        "code", _first(titles).alias("title"), F.coalesce(F.get_json_object(state, "$.code"), F.lit("")).alias("member_state_code"), F.coalesce(F.get_json_object(state, "$.label"), F.lit("")).alias("member_state_label"),
        _first(_list("caseLastDecisionDate")).alias("last_decision"),
    )


def expenditures(cases: DataFrame) -> DataFrame:
    """code, year and eur of each year of a case; amounts stand in millions, bad items are skipped, the last item of a year counts."""
    items = cases.select("code", F.posexplode(_list("caseExpenditures")).alias("i", "item"))
    read = items.select("code", "i", F.get_json_object("item", "$.year").try_cast("int").alias("year"), (F.get_json_object("item", "$.amount").try_cast("double") * 1_000_000).alias("eur"))
    return read.filter("year IS NOT NULL AND eur IS NOT NULL").groupBy("code", "year").agg(F.max_by("eur", "i").alias("eur"))


def document_links(cases: DataFrame) -> DataFrame:
    """Attachments that have a link, with rank, their order within a case: English first, then by language."""
    decisions = cases.select("code", F.posexplode("case.decisions").alias("d", "decision"))
    files = decisions.select("code", "d", _first(F.col("decision.metadata.metadataReference")).alias("reference"), F.posexplode("decision.decisionAttachments").alias("a", "file"))
    m = lambda name: _first(F.col(f"file.metadata.{name}"))
    rows = files.select("code", m("attachmentLink").alias("url"), F.lower(m("attachmentLanguage")).alias("lang"), m("attachmentName").alias("name"), m("attachmentSentDate").alias("sent"), F.col("reference").alias("decision"), "d", "a").filter("url <> ''")
    listed = rows.groupBy("code").agg(F.array_sort(F.collect_list(F.struct((F.col("lang") != "en").alias("other"), "lang", "d", "a", "url", "name", "sent", "decision"))).alias("links"))
    return listed.select("code", F.posexplode("links").alias("rank", "l")).select("code", "rank", "l.url", "l.lang", "l.name", "l.sent", "l.decision")


def _labels(name: str) -> Column:
    """Labels of the objects in a list: their own, and those of their items."""
    read = F.transform(_list(name), lambda x: F.from_json(x, "struct<label: string, items: array<struct<label: string>>>"))
    each = F.transform(read, lambda x: F.coalesce(F.transform(x["items"], lambda i: i["label"]), F.array(x["label"])))
    return F.filter(F.flatten(F.filter(each, lambda x: x.isNotNull())), lambda x: x.isNotNull())


def case_metadata(cases: DataFrame) -> DataFrame:
    return cases.select("code", _first(_list("caseTitle")).alias("title"), _first(_list("caseOriginalTitle")).alias("original_title"), _labels("caseObjectives").alias("objectives"), _labels("caseSectors").alias("sectors"),
        F.coalesce(F.try_element_at(_labels("caseMemberState"), F.lit(-1)), F.lit("")).alias("member_state"), _labels("caseAidInstruments").alias("aid_instruments"))


def linked_cases(cases: DataFrame) -> DataFrame:
    return cases.select("code", F.filter(_list("caseLinks"), lambda x: x != F.col("code")).alias("linked"))


def amount_check(awards: DataFrame, spent: DataFrame) -> DataFrame:
    """awards (sa_code, year, amount_eur) with amount_check: how the amount compares with what the case spent in the year."""
    own = spent.select(F.col("code").alias("_code"), F.col("year").alias("_year"), F.col("eur").alias("_eur"))
    joined = awards.join(own, (case_code(F.col("sa_code")) == F.col("_code")) & (F.col("year").try_cast("int") == F.col("_year")), "left")
    ratio = F.when(F.col("_eur") > 0, F.col("amount_eur") / F.col("_eur"))
    return joined.withColumn("amount_check", F.when(ratio.isNull(), "no_data").when(ratio <= 1, "confirmed").when(ratio <= 2, "plausible").otherwise("inconsistent")).drop("_code", "_year", "_eur")


def with_case_code(rows: DataFrame) -> DataFrame:
    """sa_code of TAM rows, where their record id is a case's code; else empty."""
    code = F.when(F.col("source") == "TAM", case_code(F.col("source_record_id"))).otherwise("")
    return rows.withColumn("sa_code", F.when(code.startswith("SA."), code).otherwise(""))


def unresolved(codes: DataFrame, cases: DataFrame) -> DataFrame:
    """Codes (sa_code) that no case has."""
    return codes.select(case_code(F.col("sa_code")).alias("sa_code")).filter("sa_code <> ''").distinct().join(cases.select(F.col("code").alias("sa_code")), "sa_code", "left_anti")

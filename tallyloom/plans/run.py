"""A whole run: match a list against the register, enrich, consolidate, and write tables and metrics."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import constants as K
from tallyloom.config import RunConfig, read_aliases
from tallyloom.functions.lineage import settled
from tallyloom.functions.text import phrase_pattern
from tallyloom.operators import cases, consolidation, duplicates, enrichment, evidence, matching, reference, tables
from tallyloom.sources import readers, writers

log = logging.getLogger(__name__)


@dataclass
class Inputs:
    """All that a run reads; what is None is left out."""

    awards: DataFrame
    companies: DataFrame
    aliases: list[tuple[str, str]] = field(default_factory=list)
    participants: DataFrame | None = None
    installations: DataFrame | None = None
    compliance: DataFrame | None = None
    projects: DataFrame | None = None
    projects_overview: DataFrame | None = None
    promoters: DataFrame | None = None
    cases: DataFrame | None = None
    case_documents: DataFrame | None = None


def consolidate(matched: DataFrame, config: RunConfig = RunConfig(), companies: DataFrame | None = None, evidence_by_case: DataFrame | None = None) -> DataFrame:
    """Matched and enriched rows with duplicate marks, quality, grant equivalents, groups and origin, in this order; no row is dropped."""
    prefix = config.match.output_prefix
    ref = f"{prefix}_reference_name"
    rows = matched.withColumn(ref, F.upper(F.trim(ref)))
    if evidence_by_case is not None:
        rows = evidence.add_case_evidence(cases.with_case_code(rows), evidence_by_case)
    # each rule meets the rows with themselves, so the rows are settled, once; no rule asks for another's marks, so all look for partners in the same rows
    rows = whole = settled(duplicates.with_marks(rows))
    for rule in (duplicates.mark_repeated_payments, duplicates.mark_cofinancing, duplicates.mark_confirmed_funds):
        rows = rule(rows, ref, among=whole)
    rows = duplicates.mark_listed_projects(duplicates.mark_multicountry(rows), ref, among=whole)
    rows = duplicates.add_attribution(rows, prefix)
    rows = consolidation.add_grant_equivalent(consolidation.add_quality(rows, prefix))
    if config.parent_groups:
        rows = consolidation.add_parent_group(rows, consolidation.group_members(rows.sparkSession, config.parent_groups), ref)
    if companies is not None and "hq_country" in companies.columns:
        rows = consolidation.add_origin(rows, companies, ref)
    return rows


def run(inputs: Inputs, config: RunConfig = RunConfig()) -> dict[str, DataFrame]:
    """Every result table by name. Matches and marks are computed, and kept in the checkpoint folder; the tables over them aren't yet.

    A part of enrichment that can't be planned over its inputs doesn't end the run; the table left_out names it and why, so that no incomplete result looks whole.
    """
    spark, prefix = inputs.awards.sparkSession, config.match.output_prefix
    ref = f"{prefix}_reference_name"
    aliases = reference.alias_table(spark, inputs.aliases)
    references = reference.reference_list(inputs.companies, aliases, config.match)
    matched = matching.match_awards(inputs.awards, references, aliases, config.match)
    enriched = settled(matched.filter(F.col(f"{prefix}_flag")))
    logged = matching.match_log(enriched, prefix)
    names = enrichment.company_names(inputs.companies, inputs.aliases)
    companies, topics = phrase_pattern(names), phrase_pattern(config.keywords.topics)
    out = {"enriched": enriched, "match_log": logged}
    parts: dict[str, DataFrame] = {}
    left_out: list[tuple[str, str]] = []

    def attempt(name: str, of: Callable[[], None]) -> None:
        try:
            of()
        except (AnalysisException, AttributeError, ValueError) as e:  # an input without the columns of its part
            log.exception("%s is left out", name)
            left_out.append((name, str(e).splitlines()[0]))

    payments = inputs.awards.filter(F.col("source") == "FTS")

    def bridge() -> None:
        out["fts_cordis_bridge"] = enrichment.project_bridge(payments, inputs.participants)
        out["fts_via_cordis"] = parts["bridge"] = enrichment.sector_signals(out["fts_cordis_bridge"], companies, topics)

    def allowances() -> None:
        rows = enrichment.allocations(enrichment.matching_installations(inputs.installations, companies, config.nace_filter), inputs.compliance)
        out.update(ets_matched_detail=rows, ets_matched_company_year=enrichment.allocations_by_company_year(rows), ets_matched_companies=enrichment.allocations_by_company(rows), ets_phases=enrichment.allocations_by_phase(rows))

    def projects() -> None:
        listed = spark.createDataFrame([(n.lower(), i) for i, n in enumerate(names) if len(n) > 1], "name string, ord int")
        out["ipcei_matched_participants"] = parts["projects"] = enrichment.project_awards(inputs.projects, listed, inputs.projects_overview)

    def mining() -> None:
        rest = enrichment.unmatched(payments, logged)
        out["fts_entity_candidates"] = found = enrichment.entity_candidates(rest, companies, config.keywords)
        out.update(fts_keyword_matches=enrichment.keyword_hits(rest, config.keywords), fts_recommended_aliases=enrichment.recommended_aliases(found), fts_highvalue_unmatched=enrichment.largest(rest))
        out.update(fts_company_statistics=enrichment.company_statistics(found), fts_totals=enrichment.scan_totals(payments, logged))

    def forensics() -> None:
        rest = enrichment.unmatched(inputs.awards, logged)
        out["highvalue_analysis"] = found = enrichment.forensics(rest, companies, config.keywords, config.nace_filter)
        out.update(highvalue_new_matches=enrichment.new_candidates(found), unmatched_by_source=enrichment.unmatched_statistics(rest))

    def case_tables() -> None:
        out.update(case_projects=cases.interest_projects(inputs.cases), case_expenditures=cases.expenditures(inputs.cases), case_documents=cases.document_links(inputs.cases), case_metadata=cases.case_metadata(inputs.cases))
        out.update(case_links=cases.linked_cases(inputs.cases), case_codes_unresolved=cases.unresolved(cases.with_case_code(logged).select("sa_code"), inputs.cases))

    for name, of, needed in (
        ("bridge", bridge, inputs.participants), ("allowances", allowances, inputs.compliance), ("projects", projects, inputs.projects), ("mining", mining, True), ("forensics", forensics, True), ("cases", case_tables, inputs.cases),
    ):
        if needed is not None:
            attempt(name, of)

    pattern = phrase_pattern(names, 4, K.PHRASE_BLOCKLIST)
    integrated = consolidation.integrate(logged, pattern, parts.get("bridge"), inputs.promoters, parts.get("projects"), prefix)
    joined = integrated["combined"]
    out |= {f"integrated_{name}": rows for name, rows in integrated.items() if name != "combined"}
    out["left_out"] = spark.createDataFrame(left_out, "part string, reason string")
    by_case = evidence.case_evidence(inputs.case_documents) if inputs.case_documents is not None else None
    rows = settled(consolidate(settled(joined), config, inputs.companies, by_case))
    kept = rows.filter("dc_preferred")
    out |= tables.summary_tables(kept, ref)
    if "parent_group" in rows.columns:
        out |= tables.group_tables(rows, ref)
        out["concentration_groups"] = tables.concentration(kept, "parent_group")
    out |= {"headline": tables.headline(kept, ref), "concentration_entities": tables.concentration(kept, ref), "consolidated_matches": duplicates.drop_exact_repeats(rows, ref).drop("ord")}
    return out


def run_documents(results: dict[str, DataFrame], config: RunConfig = RunConfig()) -> dict[str, dict | str]:
    """The small documents of a run by file name: measures of concentration, what enrichment added, and the summary of matches."""
    prefix = config.match.output_prefix
    kept = results["consolidated_matches"].filter("dc_preferred")
    measures = {"entities": tables.concentration_metrics(kept, f"{prefix}_reference_name")}
    if "parent_group" in kept.columns:
        measures["groups"] = tables.concentration_metrics(kept, "parent_group")
    parts = {name.removeprefix("integrated_"): df for name, df in results.items() if name.startswith("integrated_")}
    stats = consolidation.integration_stats(parts, results.get("ets_matched_companies"))
    summary = writers.summary_text("Matches", matching.match_summary(results["enriched"], prefix))
    return {"concentration_metrics.json": measures, "enrichment_stats.json": stats, "match_summary.txt": summary}


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--awards", required=True)
    parser.add_argument("--one-line-records", action="store_true", help="no field of the register's CSV holds a line end, so that the file can be split among tasks")
    parser.add_argument("--company-list", required=True)
    parser.add_argument("--aliases")
    parser.add_argument("--config")
    parser.add_argument("--participants")
    parser.add_argument("--allowances", help="archive of the emission register")
    parser.add_argument("--projects")
    parser.add_argument("--projects-overview")
    parser.add_argument("--cases", help="JSON document of state-aid cases")
    parser.add_argument("--case-documents", help="table of case documents with their text")
    parser.add_argument("--promoters", help="table of programme promoters")
    parser.add_argument("--skip-pdf-enrichment", action="store_true")
    parser.add_argument("--output-dir", required=True)
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("tallyloom").getOrCreate()
    companies = readers.read_company_list(spark, a.company_list)  # fails before any work on a wrong list
    config = RunConfig.load(a.config) if a.config else RunConfig()
    table = lambda p: readers.read_table(spark, p) if p else None
    installations, compliance = readers.read_allowances(spark, a.allowances) if a.allowances else (None, None)
    documents = None if a.skip_pdf_enrichment else table(a.case_documents)
    inputs = Inputs(
        readers.read_awards(spark, a.awards, not a.one_line_records), companies, read_aliases(a.aliases) if a.aliases else [], readers.read_participants(spark, a.participants) if a.participants else None, installations, compliance,
        table(a.projects), table(a.projects_overview), table(a.promoters), cases.read_cases(spark, a.cases) if a.cases else None, documents,
    )
    results = run(inputs, config)
    writers.write_parquet(results["match_log"], f"{a.output_dir}/match_log.parquet")
    writers.write_tables({k: v for k, v in results.items() if k != "match_log"}, a.output_dir)
    for name, what in run_documents(results, config).items():
        writers.write_document(spark, what, f"{a.output_dir}/{name}")
    print(writers.summary_text("Summary", {k: results[k] for k in ("headline", "T1_by_source", "T6_top_entities")}))
    missing = [r.part for r in results["left_out"].collect()]
    if missing:
        raise SystemExit(f"left out: {', '.join(missing)}")


if __name__ == "__main__":
    main()

import json
import zipfile

import pytest

from tallyloom.config import Keywords, MatchConfig, RunConfig
from tallyloom.operators import reference
from tallyloom.plans import run as R
from tallyloom.sources import readers, writers
from tallyloom.streaming.micro_batches import match_stream

COLUMNS = (
    "source string, source_record_id string, beneficiary_name string, country string, amount_eur double, amount_gge_eur double, year string, description string, original_columns string, financial_instrument_class string, "
    "flow_stage_group string, flow_stage string, fiscal_source_type string, is_primary_record string, entity_name_raw string, entity_name_clean string, entity_id string, entity_type string, sector_description string, nace_2digit string, "
    "exclude_reason string, programme string, fund string"
)


def award(source, i, name, amount=100.0, description=None, programme=None, country="DE", nace=None, instrument="grant"):
    return (source, i, name, country, amount, None, "2020", description, None, instrument, None, None, "x", "True", name, name.lower(), None, None, None, nace, None, programme, None)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    f = tmp_path_factory.mktemp("run")
    rows = [
        award("TAM", "SA.1", "Volkswagen"), award("KOHESIO", "k1", "Volkswagen", 50.0), award("FTS", "f1", "Uni", 70.0, "123456 - battery project", "Horizon 2020"), award("FTS", "f2", "Battery Volkswagen Lab GmbH", 2e6, "things"),
        award("FTS", "f3", "Nobody", 9e5, nace="29"), award("CINEA", "c1", "Someone", 10.0, "a project with Umicore inside"), award("TAM", "SA.2", "Umicore", 30.0, instrument="loan"),
    ]
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(f / "master.parquet"))
    (f / "list.csv").write_text("﻿company_name,country,hq_country\nVolkswagen AG,DE,DE\nUmicore,BE,BE\n", encoding="utf-8")
    (f / "people.csv").write_text('project_id,activity_type,org_name,org_country,ec_contribution\n123456,PRC,"Volkswagen AG ""R""",DE,5.0\nx,PRC,Z,DE,1\n', encoding="utf-8")
    (f / "projects.csv").write_text("company,ipcei,amount_eur_est,country\nVolkswagen AG Werk,B,99.0,DE\nNobody,B,1,DE\n", encoding="utf-8")
    (f / "overview.csv").write_text("ipcei_name,sa_case,approval_date\nB,SA.1,2019-12-09\n", encoding="utf-8")
    (f / "config.json").write_text(json.dumps({"sector_keywords": {"tier1": ["battery"], "tier2": []}, "nace_filter": "29", "parent_groups": {"VW Group": ["volkswagen"]}}))
    (f / "aliases.json").write_text(json.dumps({"_": "x", "VW": "Volkswagen AG"}))
    with zipfile.ZipFile(f / "ets.zip", "w") as z:
        z.writestr("installation.csv", "id,name,registry_id,nace_id,city\n1,Volkswagen Werk,DE,29,x\n2,Other,DE,35,y\n")
        z.writestr("compliance.csv", "installation_id,year,allocatedFree,allocatedTotal,verified\n" + "1,2020,10,10,12\n" * 1500 + "2,2020,5,5,5\n")
    spark.createDataFrame([("SA.1", 0, "en", "WLAL", "u", "It is co-financed by the ERDF .")], "code string, rank int, lang string, name string, url string, text string").write.parquet(str(f / "docs.parquet"))
    return f


def inputs(spark, f):
    installations, compliance = readers.read_allowances(spark, str(f / "ets.zip"))
    return R.Inputs(
        readers.read_awards(spark, str(f / "master.csv")), readers.read_company_list(spark, str(f / "list.csv")), [("VW", "Volkswagen AG")], readers.read_participants(spark, str(f / "people.csv")), installations, compliance,
        readers.read_table(spark, str(f / "projects.csv")), readers.read_table(spark, str(f / "overview.csv")), None, None, readers.read_table(spark, str(f / "docs.parquet")),
    )


def test_whole_run(spark, folder):
    out = R.run(inputs(spark, folder), RunConfig.load(str(folder / "config.json")))
    rows = {(r.source, r.source_record_id): r for r in out["consolidated_matches"].collect()}
    assert set(rows) == {("TAM", "SA.1"), ("KOHESIO", "k1"), ("CINEA", "c1"), ("TAM", "SA.2"), ("FTS_CORDIS", "f1"), ("IPCEI_state_aid", None)}
    tam = rows[("TAM", "SA.1")]
    assert not tam.dc_preferred and tam.dc_flag == "cofinancing_overlap:tam_kohesio|cofinancing_overlap:tam_fts_cordis_pdf|cofinancing_overlap:tam_ipcei_state_aid_pdf|cofinancing_overlap:tam_kohesio_pdf|confirmed_duplicate:ipcei_tam"
    assert tam.parent_group == "VW Group" and rows[("TAM", "SA.2")].amount_gge == 4.5 and rows[("CINEA", "c1")].match_quality == "suspect_description_only"
    assert rows[("FTS_CORDIS", "f1")].attribution_type == "consortium_partner" and rows[("TAM", "SA.2")].origin_block == "EU"
    assert {r.source for r in out["T1_by_source"].collect()} == {"KOHESIO", "CINEA", "TAM", "IPCEI_state_aid"}
    assert out["ets_matched_companies"].first().total_free_allowances == 15_000.0
    assert out["highvalue_analysis"].filter("source_record_id = 'f3'").first().match_probability == "low_nace_only"
    stats = R.run_documents(out, RunConfig.load(str(folder / "config.json")))["enrichment_stats.json"]
    assert stats["ets"]["rows"] == 1 and stats["fts_cordis"]["rows"] == 1
    assert {"TG1_groups", "headline", "concentration_groups", "fts_entity_candidates", "ipcei_matched_participants"} <= set(out)


def test_command_line(spark, folder, tmp_path, capsys):
    R.main(["--awards", str(folder / "master.parquet"), "--company-list", str(folder / "list.csv"), "--aliases", str(folder / "aliases.json"), "--config", str(folder / "config.json"), "--output-dir", str(tmp_path / "out")])
    assert "T1_by_source" in capsys.readouterr().out
    back = readers.read_csv(spark, str(tmp_path / "out" / "T1_by_source.csv"))
    assert back.columns == ["source", "total_eur", "rows", "entities"] and back.count() >= 2
    assert spark.read.parquet(str(tmp_path / "out" / "match_log.parquet")).count() >= 4
    measures = json.loads((tmp_path / "out" / "concentration_metrics.json").read_text())
    assert measures["entities"]["count"] >= 2 and set(measures) == {"entities", "groups"}
    assert "by_source" in (tmp_path / "out" / "match_summary.txt").read_text() and json.loads((tmp_path / "out" / "enrichment_stats.json").read_text()) == {}


def test_one_line_records_are_split(spark, tmp_path):
    (tmp_path / "r.csv").write_text("a,b\n" + "".join(f'{i},"x ""{i}"", y"\n' for i in range(50)), encoding="utf-8")
    got = readers.read_csv(spark, str(tmp_path / "r.csv"), multi_line=False)
    assert sorted(tuple(r) for r in got.collect()) == sorted((str(i), f'x "{i}", y') for i in range(50))


def test_a_broken_part_is_left_out(spark, folder):
    bad = inputs(spark, folder)
    bad.participants = spark.createDataFrame([(1,)], "x int")
    out = R.run(bad, RunConfig(match=MatchConfig(), keywords=Keywords()))
    assert "fts_via_cordis" not in out and "T1_by_source" in out
    assert [r.part for r in out["left_out"].collect()] == ["bridge"]


def test_lists_are_checked_first(spark, tmp_path):
    (tmp_path / "l.csv").write_text("name\nx\n")
    with pytest.raises(ValueError):
        readers.read_company_list(spark, str(tmp_path / "l.csv"))
    with pytest.raises(FileNotFoundError):
        readers.read_awards(spark, str(tmp_path / "none.parquet"))
    assert readers.read_optional(spark, str(tmp_path / "none.csv"), "a string").count() == 0


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], {"k": 1.0}, 'say "x",\nyes'), (2, [], {}, None)], "i int, l array<string>, m map<string,double>, t string")
    writers.write_csv(df, str(tmp_path / "t.csv"))
    got = {r.i: (r.l, r.m, r.t) for r in readers.read_csv(spark, str(tmp_path / "t.csv")).collect()}
    assert got["1"] == ("a|b", '{"k":1.0}', 'say "x",\nyes')
    writers.write_document(spark, {"a": 1}, str(tmp_path / "d" / "m.json"))
    assert json.loads((tmp_path / "d" / "m.json").read_text()) == {"a": 1}
    writers.write_parquet(df, str(tmp_path / "p"), ["i"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2 and readers.read_files(spark, str(tmp_path / "d")).count() == 1


def test_stream(spark, folder, tmp_path):
    awards = spark.read.parquet(str(folder / "master.parquet"))
    awards.write.parquet(str(tmp_path / "in"))
    aliases = reference.alias_table(spark, [])
    refs = reference.reference_list(readers.read_company_list(spark, str(folder / "list.csv")), aliases)
    stream = spark.readStream.schema(awards.schema).parquet(str(tmp_path / "in"))
    match_stream(stream, refs, aliases, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() >= 4

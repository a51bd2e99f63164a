import re

import pytest
from pyspark.sql import functions as F

from tallyloom.config import Keywords, MatchConfig, RunConfig, read_aliases
from tallyloom.operators import matching as M
from tallyloom.operators import reference as R

AWARDS = (
    "source string, source_record_id string, beneficiary_name string, country string, amount_eur double, amount_gge_eur double, year string, description string, original_columns string, is_primary_record string, "
    "entity_name_raw string, entity_name_clean string, programme string, fund string, financial_instrument_class string, flow_stage_group string, fiscal_source_type string"
)


def award(i, clean, source="TAM", country="DE", description=None, columns=None, primary="True", raw=None, beneficiary=None):
    return (source, str(i), beneficiary or clean, country, 1.0, None, "2020", description, columns, primary, raw or clean, clean, None, None, "grant", None, None)


def listed(spark, rows):
    return spark.createDataFrame(rows, "company_name string, country string")


LIST = [("Volkswagen AG", "DE"), ("Northvolt Battery Systems", "SE"), ("Group", ""), ("Umicore", "BE"), ("Umicore NV", "FR"), ("(only brackets)", ""), (None, "")]


@pytest.fixture(scope="module")
def refs(spark):
    aliases = R.alias_table(spark, [("VW Konzern", "Volkswagen AG"), ("ACC", "Automotive Cells Company SE"), ("Umicore", "Volkswagen AG"), ("lost", "Group")])
    return R.reference_list(listed(spark, LIST), aliases), aliases


def test_reference_list(refs):
    rows = {(r.ref_name_clean, r.ref_source) for r in refs[0].collect()}
    assert rows == {("volkswagen", "company_list"), ("northvolt battery systems", "company_list"), ("umicore", "company_list"), ("automotive cells company", "aliases")}
    assert {(r.name, r.ref, r.notes) for r in R.exact_lookup(*refs).collect()} >= {("volkswagen", "volkswagen", ""), ("vw konzern", "volkswagen", "alias:vw konzern"), ("acc", "automotive cells company", "alias:acc")}
    assert ("umicore", "volkswagen") not in {(r.name, r.ref) for r in R.exact_lookup(*refs).collect()}
    assert {r.ref: r.raw for r in R.raw_names(refs[0]).collect()}["umicore"] == "Umicore NV"
    assert {r.ref: r.countries for r in R.reference_countries(refs[0]).collect()}["umicore"] == ["BE", "FR"]
    assert {r.term for r in R.context_terms(*refs).collect()} == {"volkswagen", "northvolt battery systems", "umicore", "automotive cells company", "vw konzern"}


def test_list_without_names(spark):
    with pytest.raises(ValueError):
        R.reference_list(spark.createDataFrame([("x",)], "name string"), R.alias_table(spark, []))


def names(spark, refs, values, **config):
    got = M.match_names(spark.createDataFrame([(v,) for v in values], "name string"), *refs, MatchConfig(**config))
    return {r.name: (r.ref, r.score, r.mtype, r.notes) for r in got.collect()}


def test_name_decisions(spark, refs):
    got = names(spark, refs, ["volkswagen", "vw konzern", "", None, "systems", "volks", "northvolt battery systems germany", "battery systems northvolt stuff and very much more than that here", "battery pack", "umicore belgium", "nothing alike"])
    assert got["volkswagen"] == ("volkswagen", 100.0, "exact", "") and got["vw konzern"] == ("volkswagen", 100.0, "exact", "alias:vw konzern")
    assert got["northvolt battery systems germany"] == ("northvolt battery systems", 100.0, "fuzzy_high", "")
    assert set(got) == {"volkswagen", "vw konzern", "northvolt battery systems germany"}  # too short, too long, or one shared word only


def test_single_words_and_vetoes(spark, refs):
    assert names(spark, refs, ["umicore belgium cobalt"], single_token_match_min_len=4)["umicore belgium cobalt"] == ("umicore", 100.0, "fuzzy_medium", "single_token")
    pair = frozenset({("northvolt battery systems germany", "northvolt battery systems")})
    assert names(spark, refs, ["northvolt battery systems germany"], false_positive_pairs=pair) == {}
    assert names(spark, refs, ["northvolt battery systems germany"], exact_only_names=frozenset({"northvolt battery systems germany"})) == {}


def test_only_the_winner_is_checked_and_ties_go_by_name(spark):
    aliases = R.alias_table(spark, [])
    two = R.reference_list(listed(spark, [("beta alpha gamma", ""), ("alpha beta delta", "")]), aliases)
    assert names(spark, (two, aliases), ["alpha beta"]) == {"alpha beta": ("alpha beta delta", 100.0, "fuzzy_high", "")}
    # the best by likeness holds the name whole but is far too long; the second is never tried
    long = R.reference_list(listed(spark, [("kappa lambda " + "omicron " * 6, ""), ("kappa lambdas", "")]), aliases)
    assert names(spark, (long, aliases), ["kappa lambda"]) == {}


def matched(spark, refs, rows, **config):
    got = M.match_awards(spark.createDataFrame(rows, AWARDS), *refs, MatchConfig(**config)).collect()
    return {r.source_record_id: (r.match_flag, r.match_score, r.match_type, r.match_matched_on, r.match_reference_name, r.match_notes) for r in got}


def test_layers_in_order(spark, refs):
    rows = [
        award(1, "volkswagen", description="umicore"),
        award(2, "someone else", "FTS", description="Work with Umicore NV (and VW Konzern) on things"),
        award(3, "x", "EIB", raw="UMICORE BATTERY LOAN"),
        award(4, "nobody here", columns='{"AM_TITLE": "aid", "AM_TITLE_EN": "aid to automotive cells company"}'),
        award(5, "nobody there", columns="{broken"),
        award(6, "volkswagen", primary="False"),
        award(7, "nobody", "RESEARCH", description="umicore"),
        award(8, "nobody", "RRF", columns='{"Component Name": "VW Konzern plan"}'),
        award(9, None, description="umicores"),
        award(10, "umicore recycling hub", "RESEARCH"),
    ]
    got = matched(spark, refs, rows)
    assert got["1"] == (True, 100.0, "exact", "entity_name", "Volkswagen AG", "")
    assert got["2"] == (True, 95.0, "contextual_exact", "description", "Umicore NV", "match_in_description")
    assert got["3"][:4] == (True, 92.0, "eib_title_extraction", "entity_name_raw")
    assert got["4"][:4] == (True, 95.0, "contextual_exact", "original_columns[1]")
    assert got["8"][:3] == (True, 90.0, "contextual_exact") and got["8"][5] == "alias_match_in_field"
    assert "6" not in got and all(got[k][:3] == (False, None, "none") for k in ("5", "7", "9", "10"))
    assert matched(spark, refs, rows, context_scan_entity_name=True)["10"][:3] == (True, 93.0, "contextual_entity_name")


def test_country_and_beneficiary_vetoes(spark, refs):
    rows = [award(1, "northvolt battery sistems", country="FR"), award(2, "northvolt battery sistems", country="SE"), award(3, "northvolt battery sistems", country=""), award(4, "volkswagen", beneficiary="Volkswagen club of fans")]
    got = matched(spark, refs, rows, beneficiary_fp_patterns={"volkswagen": "club"}, fuzzy_high_threshold=99)
    assert not got["1"][0] and got["2"][2] == got["3"][2] == "fuzzy_medium"
    assert got["4"] == (False, 100.0, "vetoed_false_positive", "entity_name", "Volkswagen AG", "")
    claimed = matched(spark, refs, [award(4, "volkswagen", beneficiary="Volkswagen club", description="umicore")], beneficiary_fp_patterns={"volkswagen": "club"})
    assert claimed["4"][4] == "Umicore NV"


def test_text_hits_against_longest_first_pattern(spark):
    import random

    rng = random.Random(7)
    terms = ["alpha", "alpha beta", "beta gamma", "gamma", "delta alpha beta"]
    table = spark.createDataFrame([(t, t, False) for t in terms], "term string, ref string, is_alias boolean")
    texts = [(i, " ".join(rng.choices(["alpha", "beta", "gamma", "delta", "x"], k=rng.randrange(0, 9)))) for i in range(200)]
    got = {r.i: r.ref for r in M.text_hits(spark.createDataFrame(texts, "i int, t string"), "i", F.col("t"), table).collect()}
    pattern = re.compile(r"\b(" + "|".join(sorted(terms, key=len, reverse=True)) + r")\b")
    assert got == {i: m.group(1) for i, t in texts if (m := pattern.search(t))}


def test_summary_and_prefix(spark, refs):
    rows = spark.createDataFrame([award(1, "volkswagen"), award(2, "umicore", "FTS")], AWARDS)
    out = M.match_awards(rows, *refs, MatchConfig(output_prefix="car"))
    assert M.match_log(out, "car").count() == 2 and "beneficiary_name" in M.match_log(out, "car").columns
    assert {r.car_type: r.rows for r in M.match_summary(out, "car")["by_type"].collect()} == {"exact": 2}


def test_row_order_and_partitions_change_nothing(spark, refs):
    rows = [award(i, n, description=d) for i, (n, d) in enumerate([("volkswagen", None), ("northvolt battery systems germany", None), ("z", "umicore"), ("z", None)] * 5)]
    one = matched(spark, refs, rows)
    other = {r.source_record_id: (r.match_flag, r.match_score, r.match_type, r.match_matched_on, r.match_reference_name, r.match_notes) for r in M.match_awards(spark.createDataFrame(rows[::-1], AWARDS).repartition(7), *refs).collect()}
    assert one == other


def test_config_files(tmp_path):
    a = tmp_path / "a.json"
    a.write_text('﻿{"_note": "x", "VW": "Volkswagen", "Umicore": ["Umi", "UMC"]}', encoding="utf-8")
    assert read_aliases(str(a)) == [("VW", "Volkswagen"), ("Umi", "Umicore"), ("UMC", "Umicore")]
    (tmp_path / "g.json").write_text('{"Big": ["small"]}')
    c = tmp_path / "c.json"
    c.write_text('{"match_config": {"output_prefix": "car", "exact_only_names": ["a"]}, "sector_keywords": {"tier1": ["x"], "tier2": []}, "nace_filter": ["29", "30"], "parent_groups": "%s"}' % (tmp_path / "g.json"))
    got = RunConfig.load(str(c))
    assert (got.match.output_prefix, got.match.exact_only_names, got.nace_filter, got.parent_groups) == ("car", frozenset({"a"}), "29", {"Big": ["small"]})
    assert got.keywords.tier1 == ("x",) and Keywords.of(["a", "b"]).topics == ("a", "b") and Keywords.of(None) == Keywords()

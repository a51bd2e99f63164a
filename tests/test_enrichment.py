import json

import pytest
from pyspark.sql import functions as F

from tallyloom.config import Keywords
from tallyloom.functions.text import phrase_pattern
from tallyloom.operators import cases as C
from tallyloom.operators import enrichment as E
from tallyloom.operators import evidence as V

PAYMENTS = "source string, source_record_id string, beneficiary_name string, entity_name_clean string, country string, amount_eur double, year string, description string, programme string, original_columns string, is_primary_record string, nace_2digit string, financial_instrument_class string"


def payment(i, beneficiary="x", description=None, programme=None, amount=1.0, columns=None, source="FTS", nace=None, primary="True", clean=None):
    return (source, str(i), beneficiary, clean or (beneficiary or "").lower(), "DE", amount, "2020", description, programme, columns, primary, nace, "grant")


def frame(spark, rows):
    return spark.createDataFrame(rows, PAYMENTS)


def test_bridge_and_signals(spark):
    pay = frame(spark, [
        payment(1, "BMW AG", "123456 - A - battery", "Horizon 2020"), payment(2, "Uni", "123456 - B - x", "horizon europe"), payment(3, "Uni", "777777 - battery cell", "Research Framework"), payment(4, "Uni", "123456 - x", "Other"),
        payment(5, "Uni", "no id", "Horizon 2020"), payment(6, "Uni", "123456 - battery", "Horizon 2020"),
    ])
    people = spark.createDataFrame([("123456", "PRC", "BMW AG", "DE", 1.5), ("123456", "PRC", "Alpha", "FR", 2.0), ("123456", "HES", "Uni", "DE", 9.0), ("x", "PRC", "Z", "DE", 1.0), ("123456", "PRC", "BMW AG", "DE", None)], "project_id string, activity_type string, org_name string, org_country string, ec_contribution double")
    bridge = E.project_bridge(pay, people)
    got = {r.source_record_id: r for r in bridge.collect()}
    assert set(got) == {"1", "2", "3", "5", "6"} and got["5"].cordis_project_id is None
    assert (got["2"].company_names, got["2"].company_countries, got["2"].n_companies, got["2"].total_company_ec) == ("Alpha|BMW AG", "DE,FR", 2, 3.5)
    signals = {r.source_record_id: r.signal for r in E.sector_signals(bridge, phrase_pattern(["BMW"]), phrase_pattern(["battery"])).collect()}
    assert signals == {"1": "beneficiary_name", "2": "cordis_company", "3": "topic_keyword", "6": "company+topic"}


def test_allowances(spark):
    installations = spark.createDataFrame([(1, "Stahl BMW Werk", "DE", "24.10", "x"), (2, "Other", "FR", "24.20", "y"), (3, "bmw plant", "AT", "35", "z"), (4, None, "DE", "35", "z")], "id int, name string, registry_id string, nace_id string, city string")
    compliance = spark.createDataFrame([("1", 2019, 10.0, 12.0, 20.0), ("1", 1990, 2.0, 2.0, None), ("2", 2021, 0.0, 1.0, 1.0), ("3", 2021, 4.0, 4.0, 1.0), ("4", 2021, 9.0, 9.0, 9.0)], "installation_id string, year int, allocatedFree double, allocatedTotal double, verified double")
    found = E.matching_installations(installations, phrase_pattern(["BMW"]), "24")
    assert {r.id: (r.match_method, r.company) for r in found.collect()} == {1: ("both", "bmw"), 2: ("nace_only", "Other"), 3: ("name_only", "bmw")}
    rows = E.allocations(found, compliance)
    assert {(r.installation_id, r.year): r.eur_free_allocation for r in rows.collect()} == {("1", 2019): 250.0, ("1", 1990): 100.0, ("2", 2021): 0.0, ("3", 2021): 212.0}
    (bmw, other) = E.allocations_by_company(rows).collect()
    assert (bmw.company, bmw.installations, bmw.countries, bmw.first_year, bmw.last_year, bmw.total_eur_free) == ("bmw", 2, "AT,DE", 1990, 2021, 562.0) and other.total_eur_free == 0
    assert {(r.company, r.year): r.installations for r in E.allocations_by_company_year(rows).collect()}[("bmw", 2021)] == 1
    assert [(r.phase, r.net_benefit_eur) for r in E.allocations_by_phase(rows).collect()] == [("Phase 3 (2013-20)", -250.0), ("Phase 4 (2021-24)", 159.0)]


def test_projects(spark):
    people = spark.createDataFrame([("Volkswagen (Germany)", "B", 5.0), ("Cell Works of Umicore", "B", None), ("Nobody", "C", 1.0), ("", "C", 1.0), ("Battery Northvolt Giga", "C", 2.0)], "company string, ipcei string, amount_eur_est double")
    names = spark.createDataFrame([("volkswagen", 0), ("umicore", 1), ("northvolt battery", 2), ("x volkswagen (germany) y", 3)], "name string, ord int")
    overview = spark.createDataFrame([("B", "SA.1", "2019-12-09"), ("C", "SA.2", None)], "ipcei_name string, sa_case string, approval_date string")
    got = {r.company: (r.matched_company, r.amount_eur, r.year, r.source) for r in E.project_awards(people, names, overview).collect()}
    assert got == {"Volkswagen (Germany)": ("volkswagen", 5.0, 2019, "IPCEI_state_aid"), "Cell Works of Umicore": ("umicore", None, 2019, "IPCEI_state_aid"), "Battery Northvolt Giga": ("northvolt battery", 2.0, None, "IPCEI_state_aid")}


def test_mining(spark):
    rows = frame(spark, [
        payment(1, "BMW Works GmbH", "battery cells", amount=5.0), payment(1, "BMW Works GmbH", "battery cells", amount=5.0), payment(2, "Someone", "lithium things", amount=2e6), payment(3, "Someone", columns='{"a": "battery"}'),
        payment(4, "BMW", "roads", amount=9.0), payment(5, primary="False"), payment(6, "BMW", source="TAM"),
    ])
    keys = Keywords(("batter(y|ies)",), ("lithium",))
    hits = {(r.source_record_id, r.keyword_tier, r.keyword_matched) for r in E.keyword_hits(rows, keys).collect()}
    assert hits == {("1", "tier1", "battery"), ("2", "tier2", "lithium"), ("3", "tier1", "battery")}
    assert E.keyword_hits(rows, Keywords()).count() == 0
    found = E.entity_candidates(rows, phrase_pattern(["BMW"]), keys)
    got = [(r.source_record_id, r.matched_company, r.confidence) for r in found.collect()]
    assert got[0] == ("4", "bmw", "medium") and ("1", "bmw", "high") in got and len(got) == 3
    assert {r.entity_name_clean: (r.rows, r.total_eur) for r in E.recommended_aliases(found).collect()}["bmw works gmbh"] == (1, 5.0)
    assert {r.matched_company: r.rows for r in E.company_statistics(found).collect()} == {"bmw": 3}
    assert [r.source_record_id for r in E.largest(rows).collect()] == ["2"]
    done = frame(spark, [payment(2), payment(6, source="TAM")])
    assert sorted({r.source_record_id for r in E.unmatched(rows, done).collect()}) == ["1", "3", "4"]
    (t,) = E.scan_totals(rows.filter("source = 'FTS'"), done).collect()
    assert (t.rows, t.matched_rows, t.unmatched_rows) == (5, 1, 4)


def test_forensics(spark):
    rows = frame(spark, [payment(1, "BMW", "battery", amount=9e5, nace="29"), payment(2, "BMW", amount=8e5), payment(3, "x", "battery", amount=7e5, nace="2910"), payment(4, "x", "car", amount=6e5), payment(5, "x", amount=5.5e5), payment(6, "BMW", amount=4e5)])
    got = E.forensics(rows, phrase_pattern(["BMW"]), Keywords(("battery",), ("car",)), "29.1")
    assert [(r.source_record_id, r.match_probability, r.keyword_signal, r.company_signal) for r in got.collect()] == [("1", "very_high", "battery", "BMW"), ("2", "high", "", "BMW"), ("3", "high", "battery", ""), ("4", "low_keyword_only", "car", ""), ("5", "none", "", "")]
    assert [r.source_record_id for r in E.new_candidates(got).collect()] == ["1", "2", "3"]
    (s,) = E.unmatched_statistics(rows).collect()
    assert (s.rows, s.high_value_rows) == (6, 5)
    assert [(r.match_probability, r.rows) for r in E.value_counts(got, "match_probability").collect()][0] == ("high", 2)


def test_company_names(spark):
    listed = spark.createDataFrame([("DE", " BMW ", 1), ("DE", None, 2), ("FR", "Audi", 3)], "country string, Company_Name string, n int")
    assert E.company_names(listed, [("Bayer Motors", "BMW")]) == ["BMW", "Audi", "Bayer Motors"]


CASES = {
    "SA.1": {
        "metadata": {
            "caseTitle": ["IPCEI Batteries"], "caseMemberState": ['{"code": "DE", "label": "Germany"}'], "caseExpenditures": ['{"amount":"1.5","year":2020}', "broken", '{"amount":"2","year":2020}', '{"amount":"x","year":2021}'],
            "caseObjectives": ['{"items":[{"label":"Environment"},{"label":"Research"}]}'], "caseSectors": ['{"code":"C.24","label":"C.24 - Metals"}', "["], "caseAidInstruments": ['{"label":"Direct grant"}'], "caseLinks": ["SA.1", "SA.2"], "caseLastDecisionDate": ["2019-12-09"],
        },
        "decisions": [
            {"metadata": {"metadataReference": ["D1"]}, "decisionAttachments": [{"metadata": {"attachmentLink": ["u/fr.pdf"], "attachmentLanguage": ["FR"]}}, {"metadata": {"attachmentLink": [], "attachmentLanguage": ["EN"]}}]},
            {"metadata": {}, "decisionAttachments": [{"metadata": {"attachmentLink": ["u/en.pdf"], "attachmentLanguage": ["EN"], "attachmentName": ["WLAL"]}}, {"metadata": {"attachmentLink": ["u/de.pdf"], "attachmentLanguage": ["de"]}}]},
        ],
    },
    "SA.2": {"metadata": {"caseTitle": ["Roads"]}},
}


@pytest.fixture(scope="module")
def cases(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("cases") / "cases.json"
    path.write_text(json.dumps(CASES), encoding="utf-8")
    return C.read_cases(spark, str(path))


def test_cases(spark, cases):
    assert {r.code for r in cases.collect()} == {"SA.1", "SA.2"}
    assert [tuple(r) for r in C.interest_projects(cases).collect()] == [("SA.1", "IPCEI Batteries", "DE", "Germany", "2019-12-09")]
    assert [tuple(r) for r in C.expenditures(cases).collect()] == [("SA.1", 2020, 2e6)]
    assert [(r.rank, r.url, r.lang, r.name, r.decision) for r in C.document_links(cases).orderBy("rank").collect()] == [(0, "u/en.pdf", "en", "WLAL", ""), (1, "u/de.pdf", "de", "", ""), (2, "u/fr.pdf", "fr", "", "D1")]
    meta = {r.code: r for r in C.case_metadata(cases).collect()}
    assert (meta["SA.1"].objectives, meta["SA.1"].sectors, meta["SA.1"].member_state, meta["SA.1"].aid_instruments) == (["Environment", "Research"], ["C.24 - Metals"], "Germany", ["Direct grant"])
    assert (meta["SA.2"].title, meta["SA.2"].objectives, meta["SA.2"].member_state) == ("Roads", [], "")
    assert {r.code: r.linked for r in C.linked_cases(cases).collect()} == {"SA.1": ["SA.2"], "SA.2": []}


def test_case_amounts_and_codes(spark, cases):
    awards = spark.createDataFrame([("SA.1(2020/N)", "2020", 2e6), ("SA.1", "2020", 4e6), ("SA.1", "2020", 4.1e6), ("SA.1", "2021", 1.0), ("SA.9", "2020", 1.0)], "sa_code string, year string, amount_eur double")
    assert [r.amount_check for r in C.amount_check(awards, C.expenditures(cases)).orderBy("sa_code", "year", "amount_eur").collect()] == ["plausible", "inconsistent", "no_data", "confirmed", "no_data"]
    assert [r.sa_code for r in C.unresolved(awards, cases).collect()] == ["SA.9"]
    rows = spark.createDataFrame([("TAM", "SA.1(2020/N)"), ("TAM", "x"), ("FTS", "SA.1"), ("TAM", None)], "source string, source_record_id string")
    assert [r.sa_code for r in C.with_case_code(rows).collect()] == ["SA.1", "", "", ""]


@pytest.mark.parametrize(
    ("text", "funds", "level"),
    [
        ("The scheme is co-financed by the ERDF and the Cohesion Fund.", ["ERDF", "CF"], "confirmed"),
        ("The measure will be financed by the Recovery and Resilience Facility.", ["RRF"], "confirmed"),
        ("To the extent that the scheme is co-financed by the European Social Fund, rules apply.", [], ""),
        ("Spain does not say so, but the aid may be co-financed by European Social Fund later", ["ESF"], "conditional"),
        ("financed entirely from State resources or partly financed by the Union", [], ""),
        ("Address: Federale Overheidsdienst, rue Feder 1", [], ""),
        ("", [], ""),
    ],
)
def test_co_financing(text, funds, level):
    assert V.co_financing(text)[:2] == (funds, level)


def test_sections_forms_and_excerpts():
    text = "# A\nfunded by the ERDF yes\n## Financing from the Union fund\nThe project is funded by the Cohesion Fund.\n## B\nrest"
    assert V.fund_section(text) == "The project is funded by the Cohesion Fund." and V.fund_section("# A\nB") is None
    assert V.judge(text, markdown=True)["section_found"] and V.judge(text, markdown=True)["level"] == "confirmed"
    form = "If co-financed by Community funds FEDER - 1 000,50 EUR Feader - 0 EUR ESF+ : 2.000.000 EUR"
    assert V.form_funds(form) == {"ERDF": 1000.5, "ESF+": 2e6} or V.form_funds(form) == {"ERDF": 1000.5}
    assert V.judge(form)["level"] == "confirmed" and V.judge(form)["evidence"].startswith("[form table] ERDF: ")
    assert [V.form_amount(x) for x in ("1 000", "1,000", "1.000,00", "12,5", "0", "")] == [1000.0, 1000.0, 1000.0, 12.5, 0.0, None]
    far = "x" * 9000 + " funded by the ERDF co-financed " + "y" * 9000
    assert "funded by" in V.excerpt(far) and len(V.excerpt(far)) == 4000 and V.excerpt("abc") == "abc"


def test_technologies():
    got = V.technologies("Green hydrogen from wind power; renewable energy and clean energy. Baseload.")
    assert got["techs_found"] == ["hydrogen", "wind"] and "nuclear" in got["techs_moderate"]
    assert got["weighted_scores"]["hydrogen"] == 3 + 3 + 1 and got["primary_tech"] == "hydrogen"
    assert V.technologies("")["primary_tech"] == ""


def test_case_evidence(spark):
    docs = spark.createDataFrame(
        [("SA.1", 0, "fr", "", "u1", "financé"), ("SA.1", 1, "EN", "", "u2", "It is co-financed by the ERDF ."), ("SA.1", 2, "en", "WLAL", "u3", "It is co-financed by the ESF ."), ("SA.2", 0, "de", "", "u4", "nichts"), ("SA.3", 0, "en", "", "u5", None)],
        "code string, rank int, lang string, name string, url string, text string",
    )
    found = V.case_evidence(docs)
    assert {r.code: (r.pdf_url, r.pdf_status, r.funds, r.level) for r in found.collect()} == {"SA.1": ("u3", "parsed", ["ESF"], "confirmed"), "SA.2": ("u4", "non_english_no_match", [], ""), "SA.3": (None, "parse_failed", None, None)}
    rows = spark.createDataFrame([("SA.1",), ("SA.1",), ("SA.9",), ("",)], "sa_code string")
    assert [(r.sa_cofin_fund, r.sa_cofin_level, r.sa_pdf_status) for r in V.add_case_evidence(rows, found).orderBy("sa_code").collect()] == [("", "", ""), ("ESF", "confirmed", "parsed"), ("ESF", "confirmed", "parsed"), ("", "", "no_pdf")]
    tech = spark.createDataFrame([("SA.1", "hydrogen"), ("SA.1", "wind power wind farm"), ("SA.1", None)], "code string, text string")
    (r,) = V.case_technologies(tech).collect()
    assert (r.primary_tech, r.techs_found, r.weighted_scores) == ("wind", ["hydrogen", "wind"], {"hydrogen": 3.0, "wind": 6.0})
    files = spark.createDataFrame([("a", b"text"), ("b", b"\xff")], "path string, content binary")
    assert [r.text for r in V.texts_of(files, lambda b: b.decode()).orderBy("path").collect()] == ["text", None]
    assert V.case_evidence(docs.filter(F.lit(False))).count() == 0

import pytest

from tallyloom.operators import tables as T

ROWS = "source string, country string, financial_instrument_class string, fiscal_source_type string, year string, amount_eur double, match_reference_name string, parent_group string, dc_preferred boolean, amount_gge double"


def frame(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def row(source="S", country="DE", instrument="grant", fiscal="x", year="2020", amount=1.0, ref="A", group="G", preferred=True, gge=None):
    return (source, country, instrument, fiscal, year, amount, ref, group, preferred, gge)


def test_breakdowns_leave_unknown_keys_and_missing_amounts_out(spark):
    df = frame(spark, [row(amount=0.1), row(amount=0.2, ref="B"), row(source=None), row(source="T", amount=None)])
    assert [tuple(r) for r in T.breakdown(df, ["source"], "match_reference_name").collect()] == [("S", 0.3, 2, 2), ("T", 0.0, 0, 1)]
    assert set(T.summary_tables(df)) == {"T1_by_source", "T2_by_country", "T3_by_instrument", "T4_by_year", "T5_by_fiscal_source", "T6_top_entities", "T7_year_instrument", "T8_period_shift"}
    assert "T2_by_country" not in T.summary_tables(df.drop("country")) and "T8_period_shift" not in T.summary_tables(df.drop("year"))


def test_period_shift(spark):
    df = frame(spark, [row(year="2019"), row(year="2020"), row(year="x"), row(year=None)])
    assert [tuple(r) for r in T.period_shift(df).collect()] == [("post_2020", 1.0, 1), ("pre_2020", 1.0, 1)]


def test_pivot_and_groups(spark):
    df = frame(spark, [row(), row(source="T", amount=2.0), row(group="H", amount=9.0), row(group=None), row(source="T", group="H", preferred=False, amount=50.0)])
    assert [r.asDict() for r in T.group_tables(df)["TG2_group_source"].collect()] == [{"parent_group": "H", "S": 9.0, "T": 0.0, "TOTAL": 9.0}, {"parent_group": "G", "S": 1.0, "T": 2.0, "TOTAL": 3.0}]
    assert [(r.parent_group, r.n_rows, r.total_eur) for r in T.group_ranking(df).collect()] == [("H", 1, 9.0), ("G", 2, 3.0)]


def plain(sums):
    total, n = sum(sums), len(sums)
    s = sorted((x / total for x in sums), reverse=True)
    running, at = 0.0, 0.0
    for x in reversed(s):
        at += x
        running += at
    return {"hhi": round(sum(x * x for x in s) * 10000, 1), **{f"top{k}_pct": round(sum(s[:k]) * 100, 1) if n >= k else 0 for k in (1, 5, 10, 20)}, "gini": round(1 - 2 * running / n, 3)}


@pytest.mark.parametrize("sums", [[5.0], [1.0, 1.0], [10.0, 3.0, 2.0, 1.0], [float(x * x) for x in range(1, 8)], [float(x) for x in range(1, 26)]])
def test_concentration(spark, sums):
    df = frame(spark, [row(ref=f"n{i:02}", amount=x) for i, x in enumerate(sums)] + [row(ref=None, amount=99.0)])
    got = T.concentration_metrics(df, "match_reference_name")
    assert {k: got[k] for k in plain(sums)} == plain(sums) and got["count"] == len(sums)
    top = sorted(range(len(sums)), key=lambda i: (-sums[i], i))[:5]
    assert got["top5_names"] == [f"n{i:02}" for i in top] and got["top1_name"] == got["top5_names"][0]


def test_concentration_of_nothing(spark):
    nothing = {"count": 0, "total_eur": 0, "hhi": 0, "top5_pct": 0, "gini": 0}
    assert T.concentration_metrics(frame(spark, []), "match_reference_name") == nothing
    assert T.concentration_metrics(frame(spark, [row(amount=0.0), row(amount=None)]), "match_reference_name") == nothing


def test_headline(spark):
    (r,) = T.headline(frame(spark, [row(amount=2.0, gge=1.0), row(ref="B", year="2018.0"), row(ref=None, year="x")])).collect()
    assert (r.total_face_eur, r.total_gge_eur, r.n_relations, r.n_beneficiaries, r.top_beneficiary, r.top_beneficiary_eur, r.year_min, r.year_max) == (4.0, 1.0, 3, 2, "A", 2.0, 2018, 2020)
    (r,) = T.headline(frame(spark, [])).collect()
    assert (r.total_face_eur, r.top_beneficiary, r.year_min) == (0.0, "", None)

import re

import pytest
from pyspark.sql import functions as F

from tallyloom import constants as K
from tallyloom.functions import amounts as A
from tallyloom.functions import text as T
from tallyloom.functions.likeness import common_subsequence, indel_ratio, token_set_ratio


def col(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def out(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def plain_clean(name):
    """The rule in another language, for names of any script."""
    if name is None:
        return ""
    s = re.sub(r"\([^)]*\)", " ", name.strip().lower())
    s = re.sub(r"\b(?:" + "|".join(K.LEGAL_FORMS) + r")\b\.?", " ", s, flags=re.IGNORECASE)
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", " ", s)).strip()


NAMES = [
    None, "", "  ", "Volkswagen AG", "Ørsted A/S", "Foo Bar S.p.A. (Milano)", "GmbH & Co. KG Müller GmbH", "AB Volvo", "Alpha S.R.L.", "X Sp. z o.o.", "Zártkörűen Működő Részvénytársaság Béta", "N.V. Delta", "Société Anonyme É",
    "Gamma\tCorporation\nLimited", "Łódź Sp. z o. o.", "Ünïcode Çompany Ltd.", "INC", "A (b) C (d", "123 Co", "Gesellschaft mit beschränkter Haftung Omega",
]


def test_clean_name_against_python(spark):
    assert out(col(spark, NAMES), T.clean_name(F.col("x"))) == [plain_clean(n) for n in NAMES]


def test_other_names(spark):
    df = col(spark, ["AB Volvo", "Volvo AB", "Fiat S.p.A.", "Müller (x) GmbH"])
    assert out(df, T.clean_for_group(F.col("x"))) == ["ab volvo", "volvo ab", "fiat", "m ller"]
    assert out(df, T.clean_plain(F.col("x"))) == ["ab volvo", "volvo ab", "fiat s p a", "m ller x gmbh"]
    assert out(col(spark, ["northvolt battery systems germany a", ""]), T.significant_tokens(F.col("x"))) == [["northvolt", "battery"], []]


def test_codes_and_json(spark):
    df = col(spark, ["123456 - ACR - Title", " 12345-x", "1234 - x", "1234567890 - x", None])
    assert out(df, T.grant_id(F.col("x"))) == [123456, 12345, None, None, None]
    assert out(col(spark, ["SA.52028(2018/X)", "SA.1 (2020/NN) ", "SA.2", None]), T.case_code(F.col("x"))) == ["SA.52028", "SA.1", "SA.2", ""]
    df = col(spark, ['{"a": "x", "b": 2}', "[1]", "{", "", None])
    assert out(df, T.json_text(F.col("x"))) == ["x 2", "", "", "", ""]
    assert out(df, F.try_element_at(T.json_fields(F.col("x")), F.lit("a"))) == ["x", None, None, None, None]


def test_phrases(spark):
    p = T.phrase_pattern(["BMW", "Foo+Bar (X)", "Audi Sport", "audi", "ab", "Group"], 3, ["group"])
    df = col(spark, ["the bmw works", "bmwx", "new AUDI SPORT car", "a foo+bar (x) b", "group", "ab", None])
    assert out(df, T.found(F.col("x"), p, 1)) == ["bmw", "", "AUDI SPORT", "", "", "", ""]  # no word ends after a bracket
    assert out(df, T.has(F.col("x"), T.phrase_pattern([]))) == [False] * 7
    assert out(df, T.has(F.col("x"), T.any_pattern(["b.w", "sport"]))) == [True, True, True, False, False, False, False]


def test_flags_and_labels(spark):
    assert out(col(spark, ["", "a", None]), T.with_flag(F.col("x"), "b")) == ["b", "a|b", "b"]
    assert out(col(spark, [2.5e9, 1.25e6, 3200.0, 12.0], "double"), T.euros(F.col("x"))) == ["EUR 2.5B", "EUR 1.3M", "EUR 3K", "EUR 12"]


def test_amounts(spark):
    df = col(spark, ["loan", "Tax advantage", "tax_advantage", "unheard of", None, " Grant "])
    assert out(df, A.grant_rate(F.col("x"))) == [0.15, 0.15, 0.15, 1.0, 1.0, 1.0]
    assert out(df, A.grant_rate(F.col("x"), F.lit("Repayable advance"))) == [0.9, 0.15, 0.15, 1.0, 1.0, 1.0]
    assert out(col(spark, ["de", " FR", "HK", "US", "BR", "", None, "nan"]), A.country_block(F.col("x"))) == ["EU", "EU", "CN", "US", "Other", "Unknown", "Unknown", "Unknown"]
    assert out(col(spark, ["2020", "2020.0", "x", None, "NaN"]), A.whole(F.col("x"))) == [2020, 2020, None, None, None]
    assert out(col(spark, [2005, 2020, 1990, None], "int"), A.allowance_price(F.col("x"))) == [22.0, 25.0, 50.0, 50.0]
    df = spark.createDataFrame([(0, 100.0, 99.9), (1, 0.0, 0.0), (2, -100.0, 100.0)], "i int, a double, b double")
    assert out(df, F.round(A.relative_difference(F.col("a"), F.col("b")), 6)) == [0.001, None, 2.0]


def test_funds(spark):
    df = col(spark, [None, "", "FEDER 2021", "Own budget", "Interreg V"])
    assert out(df, A.fund_known(F.col("x"))) == [True, True, True, False, True]
    assert out(df, A.fund_among(F.col("x"), F.lit("erdf, XYZ"))) == [True, True, True, False, False]
    assert out(col(spark, ["the xyz fund"]), A.fund_among(F.col("x"), F.lit("XYZ"))) == [True]


@pytest.mark.parametrize(
    ("a", "b", "score"),
    [
        ("ford", "ford", 100), ("ford motor", "ford", 100), ("motor ford", "ford motor", 100), ("", "x", 0), ("abc", "xyz", 0),
        ("umicore belgium", "umicore poland", 200 * 7 / 21),  # the shared word against it with "poland": 7 common of 7 and 14 characters
    ],
)
def test_token_set_ratio(a, b, score):
    assert token_set_ratio(a, b) == pytest.approx(score)


def test_subsequence_against_table():
    import random

    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choices("abc", k=rng.randrange(12))) for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert common_subsequence(a, b) == t[-1][-1]
    assert indel_ratio("lewenstein", "levenshtein") == pytest.approx(100 * 18 / 21)


def test_probability_ladder(spark):
    rows = [(i, bool(i & 1), bool(i & 2), bool(i & 4), bool(i & 8)) for i in range(16)]
    df = spark.createDataFrame(rows, "i int, c boolean, s boolean, m boolean, n boolean")

    def plain(c, s, m, n):
        if c:
            return "very_high" if s or n else "high"
        if s:
            return "high" if n else "medium"
        if n:
            return "medium" if m else "low_nace_only"
        return "low_keyword_only" if m else "none"

    assert out(df, A.match_probability(*map(F.col, "csmn"))) == [plain(*r[1:]) for r in rows]

"""Evidence in decision texts: which funds co-finance a case, how surely, and which technologies it is about.

These rules need the places of matches in a text, which column expressions don't give, so they run as Arrow functions, a document at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import patterns as P

NEAR, WIDE, LOOSE = 200, 1500, 400
EVIDENCE = "funds array<string>, level string, evidence string, form_funds map<string,double>, section_found boolean"


@lru_cache(maxsize=None)
def _compiled(pattern: str, flags: int) -> re.Pattern:
    return re.compile(pattern, flags | re.IGNORECASE)


def _any(patterns: list[str], flags: int = 0) -> re.Pattern:
    return _compiled("|".join(patterns), flags)


def form_amount(text: str) -> float | None:
    """An amount as people of any country write it: a last group of one or two digits after a point or comma is a fraction, all other marks are separators."""
    digits = re.sub(r"\s", "", text).strip(".,")
    if not digits:
        return None
    parts = re.split(r"[.,]", digits)
    fraction = parts.pop() if len(parts) > 1 and len(parts[-1]) != 3 else ""
    return float(f"{''.join(parts)}.{fraction or 0}")


def form_funds(text: str) -> dict[str, float]:
    """Funds with an amount above zero in the notification form."""
    anchor = _compiled(P.FORM_ANCHOR, 0).search(text)
    out: dict[str, float] = {}
    for m in _compiled(P.FORM_ROW, 0).finditer(text[anchor.end() : anchor.end() + 400]) if anchor else ():
        name, amount = m.group(1).upper(), form_amount(m.group(2))
        if amount:
            out[P.FORM_FUNDS.get(name, name)] = amount
    return out


def fund_section(markdown: str) -> str | None:
    """What stands under the first heading about a fund."""
    head = _compiled(P.SECTION_HEADING, re.MULTILINE).search(markdown)
    if head is None:
        return None
    rest = markdown[head.end() :]
    after = re.search(r"\n#{1,4}\s+", rest)
    return (rest[: after.start()] if after else rest).strip() or None


def without_boilerplate(text: str) -> str:
    """The text with empty wordings blanked, so that places stay."""
    return _any(P.BOILERPLATE).sub(lambda m: " " * len(m.group()), text)


def _around(text: str, m: re.Match, reach: int) -> str:
    return text[max(0, m.start() - reach) : m.end() + reach]


def _quoted(text: str, m: re.Match) -> str:
    near = _around(text, m, NEAR).replace("\n", " ").strip()
    return f"...{near}..." if near else ""


def co_financing(text: str, section: str | None = None) -> tuple[list[str], str, str]:
    """Funds, level (confirmed, conditional or empty) and the wordings: the section first, then the whole text; up to three confirming places, else one that allows for it."""
    for raw in ([section] if section else []) + [text]:
        bare = without_boilerplate(raw)
        places = list(_any(P.CONFIRMED).finditer(bare))[:3]
        if places:
            funds = list(dict.fromkeys(f for m in places for f, p in P.FUNDS.items() if _compiled(p, 0).search(_around(bare, m, WIDE))))
            return funds, "confirmed", " | ".join(filter(None, (_quoted(raw, m) for m in places)))
    bare = without_boilerplate(text)
    if m := _any(P.CONDITIONAL, re.DOTALL).search(bare):
        return [f for f, p in P.FUNDS.items() if _compiled(p, 0).search(_around(bare, m, LOOSE))], "conditional", _quoted(text, m)
    return [], "", ""


def judge(text: str, markdown: bool = False) -> dict:
    """All that a decision's text says on co-financing; a form's amounts alone confirm it."""
    section = fund_section(text) if markdown else None
    amounts = form_funds(text)
    funds, level, wording = co_financing(text, section)
    funds += [f for f in amounts if f not in funds]
    if amounts and not level:
        level, wording = "confirmed", "[form table] " + "; ".join(f"{k}: {v:,.0f} EUR" for k, v in amounts.items())
    return {"funds": funds, "level": level, "evidence": wording, "form_funds": amounts, "section_found": section is not None}


def excerpt(text: str, most: int = 4000) -> str:
    """The stretch of a text with most words about co-financing; its beginning if there are none."""
    at = [m.start() for m in _compiled(P.EXCERPT_WORDS, 0).finditer(text)]
    starts = [max(0, p - most // 2) for p in at]
    best = max(starts, key=lambda s: sum(s <= p < s + most for p in at), default=0)
    return text[best : best + most]


def technologies(text: str, table: dict[str, dict[str, list[str]]] | None = None) -> dict:
    """Scores by technology (3 a strong word, 1 a moderate one), those with a strong word, those without, the first three places, and the highest score's."""
    scores: dict[str, float] = {}
    strong: set[str] = set()
    places: dict[str, list[str]] = {}
    for sector, tiers in (table or P.TECHNOLOGIES).items():
        for tier, worth in (("strong", 3.0), ("moderate", 1.0)):
            for pattern in tiers.get(tier, []):
                for m in _compiled(pattern, 0).finditer(text):
                    scores[sector] = scores.get(sector, 0.0) + worth
                    places.setdefault(sector, []).append(_around(text, m, 60).replace("\n", " ").strip())
                    if tier == "strong":
                        strong.add(sector)
    return {
        "techs_found": sorted(strong), "techs_moderate": sorted(set(scores) - strong), "tech_evidence": {k: v[:3] for k, v in places.items()},
        "primary_tech": max(scores, key=scores.get) if scores else "", "weighted_scores": scores,
    }


def evidence_column(text: Column, markdown: bool = False) -> Column:
    @F.pandas_udf(EVIDENCE)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judge(t or "", markdown) for t in texts], columns=["funds", "level", "evidence", "form_funds", "section_found"])

    return run(text)


def technology_column(text: Column) -> Column:
    @F.pandas_udf("techs_found array<string>, techs_moderate array<string>, tech_evidence map<string,array<string>>, primary_tech string, weighted_scores map<string,double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([technologies(t or "") for t in texts], columns=["techs_found", "techs_moderate", "tech_evidence", "primary_tech", "weighted_scores"])

    return run(text)


def excerpt_column(text: Column, most: int = 4000) -> Column:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: excerpt(t or "", most))

    return run(text)


def case_evidence(documents: DataFrame, markdown: bool = False) -> DataFrame:
    """Per case code, the evidence of its first readable document: English first, then full decisions (name WLAL), then by rank. documents has code, rank, lang, name, url and text (null where it can't be read)."""
    order = F.struct((F.lower("lang") != "en").alias("other"), (F.coalesce("name", F.lit("")) != "WLAL").alias("part"), "rank")
    readable = documents.filter("text IS NOT NULL").groupBy("code").agg(F.min_by(F.struct("lang", "url", "text"), order).alias("d"))
    judged = readable.withColumn("e", evidence_column(F.col("d.text"), markdown))
    silent = (F.size("e.funds") == 0) & ~F.lower("d.lang").isin("en", "")
    parsed = judged.select("code", F.col("d.url").alias("pdf_url"), F.col("d.lang").alias("pdf_lang"), F.when(silent, "non_english_no_match").otherwise("parsed").alias("pdf_status"), "e.*")
    tried = documents.groupBy("code").agg(F.count("*").alias("_n"))
    return tried.join(parsed, "code", "left").withColumn("pdf_status", F.coalesce("pdf_status", F.lit("parse_failed"))).drop("_n")


def case_technologies(documents: DataFrame) -> DataFrame:
    """Per case code, scores over all its documents; the primary technology is the one with the highest sum, the first by name of equals."""
    each = documents.filter("text IS NOT NULL").select("code", technology_column(F.col("text")).alias("t"))
    scores = each.select("code", "t.techs_found", F.explode("t.weighted_scores").alias("sector", "score"))
    summed = scores.groupBy("code", "sector").agg(F.sum("score").alias("score"), F.max(F.array_contains("techs_found", F.col("sector"))).alias("strong"))
    return summed.groupBy("code").agg(
        F.array_sort(F.collect_set(F.when(F.col("strong"), F.col("sector")))).alias("techs_found"), F.array_sort(F.collect_set(F.when(~F.col("strong"), F.col("sector")))).alias("techs_moderate"),
        F.min_by("sector", F.struct(-F.col("score"), "sector")).alias("primary_tech"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("sector", "score")))).alias("weighted_scores"),
    )


def add_case_evidence(rows: DataFrame, evidence: DataFrame) -> DataFrame:
    """rows (sa_code) with what their cases say; a case is judged once, however many rows have it."""
    own = evidence.select(
        F.col("code").alias("_code"), F.concat_ws(",", "funds").alias("sa_cofin_fund"), F.col("level").alias("sa_cofin_level"), F.col("evidence").alias("sa_cofin_evidence"), F.col("pdf_url").alias("sa_pdf_url"),
        F.col("pdf_lang").alias("sa_pdf_lang"), F.col("pdf_status").alias("sa_pdf_status"), F.to_json("form_funds").alias("sa_gber_table_funds"),
    )
    joined = rows.join(own, F.col("sa_code") == F.col("_code"), "left").drop("_code")
    texts = [c for c in own.columns if c != "_code"]
    return joined.withColumns({c: F.coalesce(c, F.when(F.col("sa_code") != "", "no_pdf").otherwise("") if c == "sa_pdf_status" else F.lit("")) for c in texts})


def texts_of(files: DataFrame, reader: Callable[[bytes], str | None]) -> DataFrame:
    """path and text of binary files (path, content); reader is any function from bytes to text, and null stands where it fails."""

    @F.pandas_udf("string")
    def run(contents: pd.Series) -> pd.Series:
        def one(x):
            try:
                return reader(x)
            except Exception:  # a broken file is a row without text
                return None

        return contents.map(one)

    return files.select("path", run("content").alias("text"))

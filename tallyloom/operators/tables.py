"""Breakdown tables, pivots and measures of concentration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.amounts import whole

#: Sums are kept as decimals, so that they don't depend on the order of rows.
MONEY = "decimal(38,2)"


def total(c: str, name: str) -> Column:
    return F.coalesce(F.sum(F.col(c).cast(MONEY)), F.lit(0).cast(MONEY)).cast("double").alias(name)


def breakdown(rows: DataFrame, by: list[str], ref: str | None = None, order_by_key: bool = False) -> DataFrame:
    """total_eur and rows (with an amount) by known keys, and the number of references if asked."""
    aggs = [total("amount_eur", "total_eur"), F.count("amount_eur").alias("rows")] + ([F.countDistinct(ref).alias("entities")] if ref else [])
    known = rows
    for c in by:
        known = known.filter(F.col(c).isNotNull())
    out = known.groupBy(*by).agg(*aggs)
    return out.orderBy(*by) if order_by_key else out.orderBy(F.desc("total_eur"), *by)


def top_entities(rows: DataFrame, ref: str, n: int = 30) -> DataFrame:
    place = "country" if "country" in rows.columns else "source"
    out = rows.filter(F.col(ref).isNotNull()).groupBy(ref).agg(total("amount_eur", "total_eur"), F.count("amount_eur").alias("rows"), F.countDistinct("source").alias("sources"), F.countDistinct(place).alias("countries"))
    return out.orderBy(F.desc("total_eur"), ref).limit(n)


def period_shift(rows: DataFrame, cut: int = 2020) -> DataFrame:
    """Sums before a year, and from it on."""
    known = rows.withColumn("_year", whole(F.col("year"))).filter("_year IS NOT NULL")
    return known.groupBy(F.when(F.col("_year") < cut, f"pre_{cut}").otherwise(f"post_{cut}").alias("period")).agg(total("amount_eur", "total_eur"), F.count("amount_eur").alias("rows")).orderBy("period")


def summary_tables(rows: DataFrame, ref: str = "match_reference_name", cut: int = 2020) -> dict[str, DataFrame]:
    """T1 to T8, by name; those whose columns are missing are left out."""
    has = set(rows.columns)
    out = {"T1_by_source": breakdown(rows, ["source"], ref)}
    if "country" in has:
        out["T2_by_country"] = breakdown(rows, ["country"], ref)
    out["T3_by_instrument"] = breakdown(rows, ["financial_instrument_class"])
    if "year" in has:
        out["T4_by_year"] = breakdown(rows, ["year"], ref, order_by_key=True)
    out["T5_by_fiscal_source"] = breakdown(rows, ["fiscal_source_type"])
    out["T6_top_entities"] = top_entities(rows, ref)
    if "year" in has:
        out["T7_year_instrument"] = breakdown(rows, ["year", "financial_instrument_class"], order_by_key=True)
        out["T8_period_shift"] = period_shift(rows, cut)
    return out


def pivot(rows: DataFrame, by: str, across: str, values: list | None = None) -> DataFrame:
    """Sums by by, a column for each value of across, 0 where there is none, and the row's total, largest first."""
    known = rows.filter(F.col(by).isNotNull() & F.col(across).isNotNull()).withColumn("_money", F.col("amount_eur").cast(MONEY))
    shaped = known.groupBy(by).pivot(across, values).agg(F.sum("_money"))
    names = [c for c in shaped.columns if c != by]
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit(0).cast(MONEY)) for c in names]
    every = sum(cells[1:], cells[0]) if cells else F.lit(0).cast(MONEY)
    return shaped.select(by, *(x.cast("double").alias(c) for x, c in zip(cells, names, strict=True)), every.cast("double").alias("TOTAL")).orderBy(F.desc("TOTAL"), by)


def group_ranking(rows: DataFrame, ref: str = "match_reference_name", group: str = "parent_group") -> DataFrame:
    place = "country" if "country" in rows.columns else "source"
    out = rows.filter(F.col("dc_preferred") & F.col(group).isNotNull()).groupBy(group).agg(
        F.countDistinct(ref).alias("n_entities"), F.count("amount_eur").alias("n_rows"), total("amount_eur", "total_eur"), total("amount_gge", "total_gge"), F.countDistinct(place).alias("n_countries"), F.countDistinct("source").alias("n_sources")
    )
    return out.orderBy(F.desc("total_eur"), group)


def group_tables(rows: DataFrame, ref: str = "match_reference_name", group: str = "parent_group") -> dict[str, DataFrame]:
    """TG1 to TG4 over preferred rows."""
    kept = rows.filter("dc_preferred")
    out = {"TG1_groups": group_ranking(rows, ref, group), "TG2_group_source": pivot(kept, group, "source"), "TG3_group_instrument": pivot(kept, group, "financial_instrument_class")}
    if "country" in rows.columns:
        out["TG4_group_country"] = pivot(kept, group, "country")
    return out


def concentration(rows: DataFrame, by: str) -> DataFrame:
    """One row: count, total_eur, hhi, top1_pct to top20_pct (0 if there are fewer entities), gini (without a correction for few entities), and the names of the top one and five.

    Names are ranked in one task, so by is a name or group, of which there are as many as the list and not as the register has.
    """
    sums = rows.filter(F.col(by).isNotNull()).groupBy(by).agg(F.coalesce(F.sum(F.col("amount_eur").cast(MONEY)), F.lit(0).cast(MONEY)).alias("money"))
    whole_sum = sums.agg(F.sum("money").alias("total"), F.count("*").alias("n")).withColumn("total", F.coalesce("total", F.lit(0).cast(MONEY)))
    ranked = sums.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("money"), F.col(by))))
    # the k-th from below is in the running sums of k shares less than all, so its share counts rank times
    parts = ranked.agg(
        F.sum(F.col("money").cast("double") * F.col("money").cast("double")).alias("squares"), F.sum(F.col("money") * F.col("rank")).cast("double").alias("running"),
        *(F.coalesce(F.sum(F.when(F.col("rank") <= k, F.col("money"))), F.lit(0)).cast("double").alias(f"top{k}") for k in (1, 5, 10, 20)),
        F.max(F.when(F.col("rank") == 1, F.col(by).cast("string"))).alias("top1_name"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("rank") <= 5, F.struct("rank", F.col(by).cast("string").alias("name"))))), lambda x: x["name"]).alias("top5_names"),
    )
    t, n = F.col("total").cast("double"), F.col("n")
    empty = (n == 0) | (t == 0)
    shares = [F.when(empty | (n < k), 0.0).otherwise(F.col(f"top{k}") / t * 100).alias(f"top{k}_pct") for k in (1, 5, 10, 20)]
    return whole_sum.crossJoin(parts).select(
        F.when(empty, 0).otherwise(n).cast("bigint").alias("count"), F.when(empty, 0.0).otherwise(t).alias("total_eur"), F.when(empty, 0.0).otherwise(F.col("squares") / (t * t) * 10000).alias("hhi"), *shares,
        F.when(empty, 0.0).otherwise(1 - 2 * (F.col("running") / t) / n).alias("gini"), F.when(empty, "").otherwise(F.col("top1_name")).alias("top1_name"), F.when(empty, F.array().cast("array<string>")).otherwise(F.col("top5_names")).alias("top5_names"),
    )


def concentration_metrics(rows: DataFrame, by: str) -> dict:
    """The row of concentration as a document, rounded as people read it; three measures less where there is nothing."""
    r = concentration(rows, by).first().asDict()
    if not r["count"]:
        return {"count": 0, "total_eur": 0, "hhi": 0, "top5_pct": 0, "gini": 0}
    return r | {k: round(r[k], 3 if k == "gini" else 1) for k in r if k in ("hhi", "gini") or k.endswith("_pct")}


def headline(rows: DataFrame, ref: str = "match_reference_name") -> DataFrame:
    """One row of a run's figures."""
    gge = [total("amount_gge", "total_gge_eur")] if "amount_gge" in rows.columns else [F.lit(None).cast("double").alias("total_gge_eur")]
    year = whole(F.col("year"))
    base = rows.agg(total("amount_eur", "total_face_eur"), *gge, F.count("*").alias("n_relations"), F.countDistinct(ref).alias("n_beneficiaries"), F.min(year).alias("year_min"), F.max(year).alias("year_max"))
    best = rows.filter(F.col(ref).isNotNull()).groupBy(ref).agg(total("amount_eur", "eur")).agg(F.max(F.struct("eur", F.col(ref).alias("name"))).alias("b"))
    return base.crossJoin(best).select(*base.columns, F.coalesce("b.name", F.lit("")).alias("top_beneficiary"), F.coalesce("b.eur", F.lit(0.0)).alias("top_beneficiary_eur"))


def ranked_bars(table: DataFrame, label: str, value: str = "total_eur", n: int = 15) -> DataFrame:
    """What a chart of the largest n shows: known labels and amounts above zero, the largest first."""
    return table.filter(F.col(label).isNotNull() & (F.col(value) > 0)).select(label, value).orderBy(F.desc(value), label).limit(n)


def year_bars(table: DataFrame, value: str = "total_eur") -> DataFrame:
    """What a chart by year shows: known years in order."""
    return table.withColumn("year", whole(F.col("year"))).filter("year IS NOT NULL").select("year", value).orderBy("year")

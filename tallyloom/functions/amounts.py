"""Amounts, rates and places as column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom import constants as K


def looked_up(c: Column, values: Mapping, default=None) -> Column:
    """values[c], or default."""
    table = F.create_map(*(F.lit(x) for x in chain.from_iterable(values.items())))
    return F.coalesce(F.try_element_at(table, c), F.lit(default))


def number(c: Column) -> Column:
    """As a double; what isn't a number, NaN too, is null."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x), x)


def whole(c: Column) -> Column:
    """A year or count as an integer, whether it came as text, number or text of a decimal; else null."""
    return number(c).try_cast("int")


def grant_rate(instrument: Column, subtype: Column | None = None) -> Column:
    """The grant equivalent of a euro. Blanks in an instrument's name count as underscores."""
    name = F.regexp_replace(F.lower(F.trim(F.coalesce(instrument, F.lit("")))), " ", "_")
    rate = looked_up(name, K.GRANT_RATES, 1.0)
    if subtype is None:
        return rate
    return F.when((name == "loan") & F.lower(F.coalesce(subtype, F.lit(""))).contains("repayable"), K.REPAYABLE_ADVANCE_RATE).otherwise(rate)


def country_block(code: Column) -> Column:
    iso = F.upper(F.trim(F.coalesce(code, F.lit(""))))
    return F.when(iso.isin("", "NAN", "NONE"), "Unknown").when(iso.isin(K.UNION), "EU").otherwise(looked_up(iso, K.BLOCKS, "Other"))


def relative_difference(a: Column, b: Column) -> Column:
    """|a - b| over the larger magnitude; null if both are 0."""
    most = F.greatest(F.abs(a), F.abs(b))
    return F.when(most > 0, F.abs(a - b) / most)


def allowance_price(year: Column) -> Column:
    return looked_up(year.cast("int"), {k: float(v) for k, v in K.ALLOWANCE_PRICES.items()}, float(K.OTHER_YEARS_PRICE))


def fund_known(fund: Column) -> Column:
    """An unknown fund (null or empty) passes; a known one must carry an alias of some fund."""
    name = F.lower(F.trim(F.coalesce(fund, F.lit(""))))
    every = sorted({a for aliases in K.FUND_ALIASES.values() for a in aliases})
    return (name == "") | F.exists(F.array(*map(F.lit, every)), lambda a: name.contains(a))


def fund_among(fund: Column, names: Column) -> Column:
    """An unknown fund passes; a known one must carry an alias of one of the names, a list in a string separated by commas."""
    name = F.lower(F.trim(F.coalesce(fund, F.lit(""))))
    table = F.create_map(*chain.from_iterable((F.lit(k), F.array(*map(F.lit, v))) for k, v in K.FUND_ALIASES.items()))
    wanted = F.filter(F.transform(F.split(F.coalesce(names, F.lit("")), ","), lambda x: F.upper(F.trim(x))), lambda x: x != "")
    aliases = F.flatten(F.transform(wanted, lambda x: F.coalesce(F.try_element_at(table, x), F.array(F.lower(x)))))
    return (name == "") | F.exists(aliases, lambda a: name.contains(a))


def match_probability(company: Column, strong: Column, medium: Column, nace: Column) -> Column:
    """How likely an unmatched award is a missed match, from what was found in it."""
    return (
        F.when(company & (strong | nace), "very_high")
        .when(company | (strong & nace), "high")
        .when(strong | (medium & nace), "medium")
        .when(nace, "low_nace_only")
        .when(medium, "low_keyword_only")
        .otherwise("none")
    )

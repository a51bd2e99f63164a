"""Names and texts as column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom import constants as K

#: A word's edge, spelled out: engines disagree about \\b at combining marks and digits.
_WORD = r"[\p{L}\p{N}_]"
EDGE = f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"
#: Matches nothing.
NEVER = "(?!)"


def stripped(c: Column) -> Column:
    """Without white space of any script at either end; null is empty."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)^\s+|\s+$", "")


def squeezed(c: Column) -> Column:
    return stripped(F.regexp_replace(c, r"(?U)\s+", " "))


def _plain(c: Column) -> Column:
    """Everything but a-z, 0-9 and white space becomes a blank; letters with marks too."""
    return squeezed(F.regexp_replace(c, r"(?U)[^a-z0-9\s]", " "))


def clean_name(c: Column) -> Column:
    """A name for comparing: lower case, without brackets and legal forms, ASCII letters and digits only. Null is empty."""
    bare = F.regexp_replace(F.lower(stripped(c)), r"\([^)]*\)", " ")
    return _plain(F.regexp_replace(bare, f"(?iU){EDGE}(?:{'|'.join(K.LEGAL_FORMS)}){EDGE}\\.?", " "))


def clean_plain(c: Column) -> Column:
    """As clean_name, but legal forms stay."""
    return _plain(F.lower(stripped(c)))


def clean_for_group(c: Column) -> Column:
    """A name for parent groups: only a legal form at the end goes."""
    bare = F.regexp_replace(F.lower(stripped(c)), r"\([^)]*\)", "")
    return _plain(F.regexp_replace(bare, f"(?iU){EDGE}(?:{'|'.join(K.TRAILING_FORMS)}){EDGE}\\.?\\s*$", ""))


def significant_tokens(clean: Column) -> Column:
    """The distinct words of a clean name that may tell it from others."""
    common = F.array(*(F.lit(x) for x in sorted({*K.COUNTRY_TOKENS, *K.TRIVIAL_TOKENS})))
    words = F.filter(F.split(clean, " "), lambda w: F.length(w) > 1)
    return F.array_except(F.array_distinct(words), common)


def escaped(phrase: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}&~#\-\s])", r"\\\1", phrase)


def phrase_pattern(phrases: Iterable[str], least: int = 3, blocked: Iterable[str] = ()) -> str:
    """One pattern for all phrases of least characters or more, as whole words in any case, the longest first."""
    out = {p.strip().lower() for p in phrases if p}
    kept = sorted((p for p in out if len(p) >= least and p not in set(blocked)), key=lambda p: (-len(p), p))
    return f"(?iu){EDGE}({'|'.join(map(escaped, kept))}){EDGE}" if kept else NEVER


def any_pattern(patterns: Iterable[str]) -> str:
    """One pattern for patterns given as such, in any case."""
    kept = [p for p in patterns if p]
    return f"(?iu){'|'.join(kept)}" if kept else NEVER


def found(c: Column, pattern: str, group: int = 0) -> Column:
    """The first match, or an empty string."""
    return F.regexp_extract(F.coalesce(c.cast("string"), F.lit("")), pattern, group)


def has(c: Column, pattern: str) -> Column:
    return F.coalesce(c.cast("string"), F.lit("")).rlike(pattern)


def grant_id(c: Column) -> Column:
    """The grant agreement number that a description begins with (5 to 9 digits and a dash), or null."""
    return F.regexp_extract(stripped(c), r"^(\d{5,9})\s*-\s*", 1).try_cast("bigint")


def case_code(c: Column) -> Column:
    """A state-aid case code without a trailing (year/letter)."""
    return stripped(F.regexp_replace(stripped(c), r"\s*\(\d{4}/[A-Z]+\)\s*$", ""))


def json_fields(c: Column) -> Column:
    """A JSON object's values as text, or null for anything else."""
    return F.from_json(c, "map<string,string>", {"mode": "PERMISSIVE"})


def json_text(c: Column) -> Column:
    """All values of a JSON object, separated by blanks."""
    return F.coalesce(F.concat_ws(" ", F.map_values(json_fields(c))), F.lit(""))


def search_text(*columns: Column) -> Column:
    return F.concat_ws(" ", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))


def with_flag(flags: Column, flag: Column | str) -> Column:
    """flags, a list in a string, with one more at its end."""
    one = F.lit(flag) if isinstance(flag, str) else flag
    return F.when(F.coalesce(flags, F.lit("")) == "", one).otherwise(F.concat(flags, F.lit("|"), one))


def euros(c: Column) -> Column:
    """An amount as people read it: billions, millions, thousands."""
    size = F.abs(c)
    label = lambda unit, fmt, end: F.concat(F.lit("EUR "), F.format_string(fmt, c / unit), F.lit(end))
    return F.when(size >= 1e9, label(1e9, "%.1f", "B")).when(size >= 1e6, label(1e6, "%.1f", "M")).when(size >= 1e3, label(1e3, "%.0f", "K")).otherwise(label(1.0, "%.0f", ""))

"""What a run can set."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from tallyloom import constants as K


@dataclass(frozen=True)
class MatchConfig:
    """Thresholds and lists of matching; the defaults are those of the published method."""

    fuzzy_high_threshold: float = 85
    fuzzy_medium_threshold: float = 75
    token_overlap_min: int = 2
    length_ratio_max: float = 2.5
    short_name_max_len: int = 5
    context_min_len: int = 6
    single_token_match_min_len: int = 0
    context_scan_entity_name: bool = False
    exact_only_names: frozenset[str] = frozenset()
    master_exclude: frozenset[str] = frozenset(K.LIST_EXCLUDE)
    contextual_blocklist: frozenset[str] = frozenset()
    #: Pairs of clean names that are never the same, in either order.
    false_positive_pairs: frozenset[tuple[str, str]] = frozenset()
    #: Clean reference name to a pattern; a beneficiary that fits it isn't meant by names that begin with the reference.
    beneficiary_fp_patterns: dict[str, str] = field(default_factory=dict)
    source_context_fields: dict[str, list[str]] = field(default_factory=lambda: dict(K.CONTEXT_FIELDS))
    layer_b_sources: frozenset[str] = frozenset(K.CONTEXT_SOURCES)
    output_prefix: str = "match"


@dataclass(frozen=True)
class Keywords:
    """Patterns of a sector: strong ones, others, and plain topic phrases."""

    tier1: tuple[str, ...] = ()
    tier2: tuple[str, ...] = ()
    topics: tuple[str, ...] = ()

    @classmethod
    def of(cls, value) -> Keywords:
        """From a list of phrases, or from a dictionary with tier1 and tier2 (or strong and medium)."""
        if not value:
            return cls()
        if isinstance(value, dict):
            one, two = (tuple(value.get(a) or value.get(b) or ()) for a, b in (("tier1", "strong"), ("tier2", "medium")))
            return cls(one, two, one + two)
        return cls(tuple(value), (), tuple(value))


@dataclass(frozen=True)
class RunConfig:
    match: MatchConfig = MatchConfig()
    keywords: Keywords = Keywords()
    nace_filter: str | None = None
    parent_groups: dict[str, list[str]] | None = None

    @classmethod
    def load(cls, path: str) -> RunConfig:
        """From a JSON file with match_config, sector_keywords, nace_filter (a string, or a list whose first counts) and parent_groups (groups, or the path of a file with them)."""
        with open(path, encoding="utf-8-sig") as f:
            raw = json.load(f)
        own = {k: frozenset(v) if isinstance(v, list) else v for k, v in (raw.get("match_config") or {}).items() if k in MatchConfig.__dataclass_fields__}
        groups, nace = raw.get("parent_groups"), raw.get("nace_filter")
        if isinstance(groups, str):
            with open(groups, encoding="utf-8-sig") as f:
                groups = json.load(f)
        nace = nace[0] if isinstance(nace, list) and nace else nace or None
        return cls(MatchConfig(**own), Keywords.of(raw.get("sector_keywords")), nace, groups)


def read_aliases(path: str) -> list[tuple[str, str]]:
    """Pairs (alias, canonical) of a JSON object, which maps aliases to names or names to lists of aliases; keys that begin with _ are comments."""
    with open(path, encoding="utf-8-sig") as f:
        raw = json.load(f)
    out: list[tuple[str, str]] = []
    for key, value in raw.items():
        if not key.startswith("_"):
            out += [(a, key) for a in value] if isinstance(value, list) else [(key, value)]
    return out

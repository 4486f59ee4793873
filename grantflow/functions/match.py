"""Key matchers of the purge commands: pattern in, predicate out."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Matcher = Callable[[Column], Column]

# Prepared keys written by each source.
SHEET_KEYS = r"\d{3}/\d{3,}/ffis\.org/v1\.json"
REGISTRY_KEYS = (
    r"\d{3}/\d{3,}/grants\.gov/v2(?:\.OpportunitySynopsisDetail_1_0|\.OpportunityForecastDetail_1_0)?\.xml"
)


def regex_matcher(pattern: str) -> Matcher:
    """The whole key must match."""
    re.compile(pattern)
    return lambda key: key.rlike(rf"^(?:{pattern})\z")


def glob_regex(glob: str) -> str:
    """Anchored regex for a glob in which ``*`` and ``?`` stop at a slash."""
    out, i = [], 0
    while i < len(glob):
        ch = glob[i]
        if ch == "*":
            out.append("[^/]*")
        elif ch == "?":
            out.append("[^/]")
        elif ch == "[":
            end = glob.find("]", i + 2)
            if end < 0:
                raise ValueError(f"unclosed character class in {glob!r}")
            out.append(glob[i:end + 1])
            i = end
        elif ch == "\\":
            i += 1
            if i == len(glob):
                raise ValueError(f"trailing backslash in {glob!r}")
            out.append(re.escape(glob[i]))
        else:
            out.append(re.escape(ch))
        i += 1
    return "".join(out)


def glob_matcher(glob: str) -> Matcher:
    pattern = glob_regex(glob)
    return lambda key: key.rlike(rf"^(?:{pattern})\z")


sheet_keys = regex_matcher(SHEET_KEYS)
registry_keys = regex_matcher(REGISTRY_KEYS)


def all_keys(key: Column) -> Column:
    return F.lit(True)


def any_of(key: Column, matchers: list[Matcher], prefix: str = "") -> Column:
    """True when one of the matchers takes the key; a key can match only once."""
    if not matchers:
        raise ValueError("at least one matcher is required")
    hit = matchers[0](key)
    for matcher in matchers[1:]:
        hit = hit | matcher(key)
    return hit & key.startswith(prefix) if prefix else hit

"""Labels for publication and report titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estatelens.functions.text import blank_to_null, strip
from estatelens.vocab import EVENT_SUBTYPES, EVENT_TYPES, INSOLVENCY_TYPES


def _first_keyword(text: Column, pairs: list[tuple[str, str]], default: str | None) -> Column:
    lowered = F.lower(text)
    label = F
    for keyword, value in pairs:
        label = label.when(lowered.contains(keyword), value)
    return label.otherwise(F.lit(default))


def _longest_first(pairs: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return sorted(pairs, key=lambda pair: len(pair[0]), reverse=True)


def event_type(description: Column) -> Column:
    """Label of the longest keyword present, else ``unknown``."""
    return _first_keyword(description, _longest_first(EVENT_TYPES), "unknown")


def event_subtype(description: Column) -> Column:
    """Label of the longest keyword present, else NULL."""
    return _first_keyword(description, _longest_first(EVENT_SUBTYPES), None)


def insolvency_type(description: Column) -> Column:
    """Label of the first keyword present in declaration order, else ``unknown``."""
    return _first_keyword(description, INSOLVENCY_TYPES, "unknown")


def report_type(title: Column) -> Column:
    """Report title without its date tail."""
    head = strip(F.regexp_extract(title, r"(?U)^[^:\d]*", 0))
    return F.coalesce(blank_to_null(head), F.lit("Verslag"))

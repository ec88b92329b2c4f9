"""Pseudonyms and redaction of natural persons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estatelens.functions.text import filled, strip
from estatelens.vocab import COMPANY_SUFFIXES, LEGAL_FORM, NOT_A_NAME, PERSON_SPAN

PERSON_TOKEN = "[persoon]"


def salted_hash(value: Column, salt: str) -> Column:
    """First 12 hex digits of SHA-256 over salt and value, the value taken as is."""
    return F.substring(F.sha2(F.concat(F.lit(salt), value), 256), 1, 12)


def person_hash(name: Column, salt: str) -> Column:
    """As :func:`salted_hash` after trimming and lower-casing; the two are not comparable."""
    return salted_hash(F.lower(strip(name)), salt)


def has_company_suffix(name: Column) -> Column:
    lowered = F.lower(name)
    found = F.lit(False)
    for suffix in COMPANY_SUFFIXES:
        found = found | lowered.contains(suffix)
    return found


def person_pattern(any_capital: bool = False) -> str:
    """Honorific-and-name pattern; ``any_capital`` also accepts accented initials."""
    return PERSON_SPAN.format(cap=r"\p{Lu}" if any_capital else "A-Z")


def redact_persons(text: Column, any_capital: bool = False) -> Column:
    """Replace an honorific with the name after it by a neutral token."""
    replaced = F.regexp_replace(text, person_pattern(any_capital), PERSON_TOKEN + " ")
    return strip(F.replace(replaced, F.lit(PERSON_TOKEN + "  "), F.lit(PERSON_TOKEN + " ")))


def is_person_name(name: Column) -> Column:
    """A real name, as opposed to a placeholder such as 'een natuurlijk persoon'."""
    return (F.length(name) >= 4) & ~name.rlike(NOT_A_NAME) & name.rlike("[A-Z]")


def looks_like_company(name: Column) -> Column:
    return F.coalesce(name.rlike(LEGAL_FORM), F.lit(False))


def known_person_pattern(names: Column) -> Column:
    """One pattern per row from its list of names: every name and longer surname, longest first.

    NULL for rows without names, since an empty pattern would match everywhere.
    """
    surnames = F.filter(
        F.transform(names, lambda p: strip(F.regexp_replace(p, r"(?U)^(?:[A-Z]\.\s*)+", ""))),
        lambda s: F.length(s) > 3)
    ranked = F.array_sort(F.transform(
        F.array_distinct(F.concat(names, surnames)),
        lambda p: F.struct((-F.length(p)).alias("rank"), p.alias("name"))))
    quoted = F.transform(ranked, lambda p: F.concat(
        F.lit(r"\Q"), F.replace(p["name"], F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")))
    return F.when(F.size(quoted) > 0, F.concat(F.lit("(?iU)"), F.array_join(quoted, "|")))


def scrub_known_persons(text: Column, pattern: Column) -> Column:
    """Replace every hit of the row's own name pattern by the token."""
    return F.coalesce(F.regexp_replace(text, pattern, F.lit(PERSON_TOKEN)), text)


def anonymise_debtor(debtor: Column, entity: Column, salt: str) -> Column:
    """Debtor struct without personal data; companies pass through unchanged."""
    sole_trader = entity == "eenmanszaak"
    name = F.when(filled(debtor["name"]), salted_hash(debtor["name"], salt)).otherwise(
        debtor["name"])
    trade_names = F.when(sole_trader, debtor["trade_names"]).otherwise(F.transform(
        debtor["trade_names"],
        lambda n: F.when(has_company_suffix(n), n).otherwise(salted_hash(n, salt))))

    def stripped(a: Column) -> Column:
        keep = sole_trader & ~a["type"].isin("woon", "correspondentie")
        return F.struct(a["type"].alias("type"),
                        *[F.when(keep, a[f]).alias(f) for f in ("street", "number", "postcode")],
                        a["city"].alias("city"))

    hidden = F.struct(name.alias("name"), debtor["kvk_nummer"].alias("kvk_nummer"),
                      trade_names.alias("trade_names"),
                      F.transform(debtor["addresses"], stripped).alias("addresses"))
    return F.when(entity.isin("person", "eenmanszaak"), hidden).otherwise(debtor)

"""Case numbers and storage keys derived from report ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estatelens.functions.text import let
from estatelens.vocab import OLD_COURT_NUMBERS

_SEP = "[._]"
_TAIL = rf"(\d{{2}}){_SEP}(\d+){_SEP}([A-Z]){_SEP}V{_SEP}"
_NEW_FORM = rf"^(\d{{2}}){_SEP}([a-z]{{2,4}}){_SEP}{_TAIL}"
_OLD_FORM = rf"^([a-z]{{2,4}}){_SEP}{_TAIL}"


def old_court_number(abbreviation: Column) -> Column:
    """Two-digit number of a pre-2013 court, NULL when unknown."""
    numbers = F.create_map(*[F.lit(f"{v:02d}" if isinstance(v, int) else v)
                             for pair in OLD_COURT_NUMBERS.items() for v in pair])
    return F.try_element_at(numbers, abbreviation)


def case_number(letter: Column, court: Column, year: Column, serial: Column) -> Column:
    bare_serial = F.regexp_replace(serial, r"^0+(?=\d)", "")
    return F.concat(letter, F.lit("."), court, F.lit("/"), year, F.lit("/"), bare_serial)


def derive_case_number(report_id: Column) -> Column:
    """STRUCT(case_key, insolventienummer) of a listed report id.

    Both spellings of one case share a key.  Ids of unknown courts keep their key with an empty
    number; unreadable ids give two empty strings, so they stay visible.
    """

    def shaped(hits: Column) -> Column:
        new = F.split(hits["new_form"], _SEP)
        old = F.split(hits["old_form"], _SEP)
        n, o = (lambda i: F.get(new, F.lit(i))), (lambda i: F.get(old, F.lit(i)))
        key = (F.when(hits["new_form"] != "",
                      F.array_join(F.slice(new, 1, 5), "_"))
               .when(hits["old_form"] != "", F.array_join(F.slice(old, 1, 4), "."))
               .otherwise(""))
        number = (F.when(hits["new_form"] != "", case_number(n(4), n(0), n(2), n(3)))
                  .when(hits["old_form"] != "",
                        case_number(o(3), old_court_number(o(0)), o(1), o(2))))
        return F.struct(key.alias("case_key"),
                        F.coalesce(number, F.lit("")).alias("insolventienummer"))

    hits = F.struct(F.regexp_extract(report_id, _NEW_FORM, 0).alias("new_form"),
                    F.regexp_extract(report_id, _OLD_FORM, 0).alias("old_form"))
    return let(hits, shaped)


def underscored(report_id: Column) -> Column:
    return F.translate(report_id, ".", "_")


def report_path(report_id: Column, project: str) -> Column:
    """Storage key of a report file."""
    return F.concat(F.lit(f"{project}/pdfs/"), report_id, F.lit(".pdf"))

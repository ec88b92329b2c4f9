"""Sections of a trustee's report, as one row-wise expression (no shuffle of report text)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estatelens.functions.text import H, let, strip, unify_line_ends
from estatelens.vocab import SECTION_HEADERS

_ANY_HEADER = "(?:" + "|".join(p.format(h=H) for _, _, p in SECTION_HEADERS) + ")"
# the first look is at one character, so that other lines cost little
_BEFORE_HEADER = rf"(?dimU)^(?={H}*[a0-9])(?={H}*{_ANY_HEADER})"
_STARTS_WITH_HEADER = rf"(?imU)\A{H}*{_ANY_HEADER}"
_HEADER_MARK = rf"(?iU)\A{H}*(a|\d+\.[58]?)"


def split_sections(text: Column, plain: Column | None = None) -> Column:
    """MAP(section, text).

    The text is cut before every header line.  The first occurrence of a header opens its
    section; a repeated header stays inside the section that is open.  Text before the first
    header is ``head``; without any header the whole text is.  ``plain`` is the text with its line
    ends unified, where a caller has it.
    """
    marks = F.create_map(*[F.lit(v) for key, mark, _ in SECTION_HEADERS for v in (mark, key)])

    def name(piece: Column, i: Column) -> Column:
        mark = F.lower(F.regexp_extract(piece, _HEADER_MARK, 1))
        return (F.when((i == 0) & ~piece.rlike(_STARTS_WITH_HEADER), "head")
                .otherwise(F.try_element_at(marks, mark)))

    def open_sections(p: Column) -> Column:
        first_hits = F.filter(
            F.sequence(F.lit(1), F.size(p["names"])),
            lambda i: F.array_position(p["names"], F.get(p["names"], i - 1)) == i)
        return let(F.struct(p["pieces"].alias("pieces"), p["names"].alias("names"),
                            first_hits.alias("starts")), assemble)

    def assemble(p: Column) -> Column:
        def section(start: Column, j: Column) -> Column:
            end = F.coalesce(F.get(p["starts"], j + 1), F.size(p["pieces"]) + 1)
            body = strip(F.array_join(F.slice(p["pieces"], start, end - start), ""))
            return F.struct(F.get(p["names"], start - 1).alias("key"), body.alias("value"))

        return F.map_from_entries(F.transform(p["starts"], section))

    def named(pieces: Column) -> Column:
        no_header = (F.size(pieces) == 1) & ~F.get(pieces, F.lit(0)).rlike(_STARTS_WITH_HEADER)
        return F.when(no_header, F.create_map(F.lit("head"), text)).otherwise(
            let(F.struct(pieces.alias("pieces"), F.transform(pieces, name).alias("names")),
                open_sections))

    return F.when(text.isNotNull(),
                  let(F.split(unify_line_ends(text) if plain is None else plain,
                              _BEFORE_HEADER), named))


def pick_section(key: str, *sections: Column) -> Column:
    """First non-empty text of a section over several reports, in the given order."""
    texts = [F.nullif(F.try_element_at(s, F.lit(key)), F.lit("")) for s in sections]
    return F.coalesce(*texts, F.lit(""))


def settlement_tail(creditors: Column, length: int | None = None) -> Column:
    """Text from subsection 8.7 on, or the whole section when there is none; ``length`` keeps so
    many characters of the former's beginning or the latter's end."""
    start = F.instr(creditors, "8.7")
    if length is None:
        return F.when(start > 0, F.substring(creditors, start, F.length(creditors))) \
            .otherwise(creditors)
    return F.when(start > 0, F.substring(creditors, start, F.lit(length))).otherwise(
        F.right(creditors, F.lit(length)))


def governance_tail(section: Column, length: int | None = None) -> Column:
    """The governance section; its newest entries stand at its end, of which ``length`` keeps so
    many characters."""
    return section if length is None else F.right(section, F.lit(length))

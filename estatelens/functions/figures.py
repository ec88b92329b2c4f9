"""Money and headcount figures in report text, as row-wise expressions.

Each figure needs one or two pattern scans of the text; the line rules (windows, first/last
value) are part of the patterns or work on the few hits, never on all lines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estatelens.functions.text import (
    EURO, H, let, matched_euro, opening, unify_line_ends,
)
from estatelens.vocab import (
    ASSET_CATEGORIES, DEBT_LABELS, DEBT_SUBSECTIONS, ESTATE_LABELS, HEADCOUNT_HEADERS,
    RECOVERY_LABELS,
)

REVENUE_ROW = "struct<jaar:int,omzet:double,winst_verlies:double,balanstotaal:double>"
_CELLS = ("omzet", "winst_verlies", "balanstotaal")

# ------------------------------------------------------------------------------- revenue table

_REVENUE_HEADER = rf"(?U)Jaar{H}+Omzet"


def parse_revenue(text: Column) -> Column:
    """ARRAY of yearly revenue, result and balance total, read by column position.

    An amount belongs to the column whose header midpoint it starts before, so empty cells do
    not shift values.  A repeated year means a table over several companies: no rows at all.
    """
    no_rows = F.array().cast(f"array<{REVENUE_ROW}>")
    def table(rows: Column) -> Column:
        header = F.get(rows, F.lit(0))
        at = {w: F.instr(header, w) - 1 for w in ("Omzet", "Winst", "Balanstotaal")}
        marked = F.transform(
            F.slice(rows, 2, 13),
            lambda ln: F.struct(
                ln.alias("line"),
                # text until the rows are made: a cast that fails costs far more than a look
                F.regexp_extract(ln, r"(?U)^\s*((?:19|20)[0-9]{2})\b", 1).alias("jaar"),
                (~ln.rlike(r"(?U)\S")).alias("blank")))
        parts = F.struct(
            marked.alias("marked"),
            F.floor((at["Winst"] + at["Omzet"]) / 2).alias("b1"),
            F.floor((at["Balanstotaal"] + at["Winst"]) / 2).alias("b2"))
        return F.when(F.contains(header, F.lit("Winst")), let(parts, from_first_year))

    def from_first_year(t: Column) -> Column:
        first = F.array_position(F.transform(t["marked"], lambda m: m["jaar"] != ""),
                                 F.lit(True))
        tail = F.when(first > 0, F.slice(t["marked"], first.cast("int"), F.lit(13)))
        return let(F.struct(tail.alias("tail"), t["b1"].alias("b1"), t["b2"].alias("b2")),
                   until_stop)

    def until_stop(t: Column) -> Column:
        stop = F.array_position(
            F.transform(t["tail"], lambda m: (m["jaar"] == "") & ~m["blank"]), F.lit(True))
        upto = F.when(stop > 0, stop.cast("int") - 1).otherwise(F.lit(13))
        years = F.filter(F.slice(t["tail"], F.lit(1), upto), lambda m: m["jaar"] != "")
        return let(F.struct(years.alias("years"), t["b1"].alias("b1"), t["b2"].alias("b2")),
                   to_rows)

    def to_rows(t: Column) -> Column:
        seen = F.transform(t["years"], lambda m: m["jaar"])
        rows = F.transform(t["years"], lambda m: cells(m, t["b1"], t["b2"]))
        return F.when(F.size(F.array_distinct(seen)) == F.size(seen), rows)

    def cells(m: Column, b1: Column, b2: Column) -> Column:
        # every amount starts a piece, so running lengths give its column
        empty = F.struct(F.lit(0).alias("at"),
                         *[F.lit(None).cast("double").alias(c) for c in _CELLS])

        def add(acc: Column, piece: Column) -> Column:
            amount = matched_euro(F.regexp_extract(piece, rf"(?U)\A{EURO}", 0))
            mine = {"omzet": acc["at"] < b1,
                    "winst_verlies": (acc["at"] >= b1) & (acc["at"] < b2),
                    "balanstotaal": (acc["at"] >= b1) & (acc["at"] >= b2)}
            return let(amount, lambda value: F.struct(
                (acc["at"] + F.length(piece)).alias("at"),
                *[F.when(mine[c] & value.isNotNull(), value).otherwise(acc[c]).alias(c)
                  for c in _CELLS]))

        total = F.aggregate(F.split(m["line"], "(?=€)"), empty, add)
        return let(total, lambda a: F.struct(m["jaar"].cast("int").alias("jaar"),
                                             *[a[c].alias(c) for c in _CELLS]))

    def header_on(all_lines: Column) -> Column:
        # the header line and the 13 lines after it
        header = F.get(F.filter(all_lines, lambda ln: F.contains(ln, F.lit("Balanstotaal"))
                                & ln.rlike(_REVENUE_HEADER)), F.lit(0))
        return F.slice(all_lines, F.array_position(all_lines, header).cast("int"), F.lit(14))

    # most texts hold no table, which a plain search tells
    found = F.when(F.contains(text, F.lit("Balanstotaal")), let(
        let(F.split(unify_line_ends(text), "\n"), header_on),
        lambda rows: F.when(F.size(rows) > 0, let(rows, table))))
    return F.coalesce(found, no_rows)


def merge_revenue(primary: Column, secondary: Column) -> Column:
    """Union by year, sorted; cells of ``primary`` win where filled, ``secondary`` fills gaps."""
    years = F.array_sort(F.array_distinct(F.concat(
        F.transform(primary, lambda r: r["jaar"]), F.transform(secondary, lambda r: r["jaar"]))))

    def row(year: Column) -> Column:
        pick = [F.get(F.filter(rows, lambda r: r["jaar"] == year), F.lit(0))
                for rows in (primary, secondary)]
        return F.struct(year.alias("jaar"),
                        *[F.coalesce(pick[0][c], pick[1][c]).alias(c) for c in _CELLS])

    return F.transform(years, row)


# --------------------------------------------------------------------------- financial reports

# one scan collects every "(sub)totaal <category> ... amount"; the lookahead consumes nothing, so
# that two labels on one line both count
_TOTALS = (r"(?iU)[Tt]otaal(?=(\s+(?:" + "|".join(p for _, p in ASSET_CATEGORIES)
           + rf")[^\n€]*{EURO}))")


def asset_realizations(text: Column) -> Column:
    """MAP(category, proceeds): last total line per category wins, zero amounts dropped."""

    def entry(hits: Column, key: str, pattern: str) -> Column:
        mine = F.filter(hits, lambda h: h.rlike(rf"(?iU)\A\s+{pattern}"))
        last = F.try_element_at(mine, F.lit(-1))
        return F.struct(F.lit(key).alias("key"),
                        matched_euro(F.regexp_extract(last, f"(?U){EURO}", 0)).alias("value"))

    def pick(hits: Column) -> Column:
        entries = [entry(hits, key, pattern) for key, pattern in ASSET_CATEGORIES]
        kept = F.filter(F.array(*entries), lambda e: e["value"].isNotNull() & (e["value"] != 0))
        return F.map_from_entries(kept)

    return let(F.regexp_extract_all(text, F.lit(_TOTALS), F.lit(1)), pick)


def estate_balances(text: Column) -> Column:
    """STRUCT of the three labelled estate balances (first hit, case-sensitive)."""
    return F.struct(*[
        matched_euro(F.regexp_extract(text, rf"(?U){label}\s+({EURO})", 1)).alias(key)
        for key, label in ESTATE_LABELS])


def creditor_recovery(text: Column) -> Column:
    """STRUCT per creditor class: claimed, paid and recovery percentage."""

    def parts(line: Column) -> Column:
        amounts = F.regexp_extract_all(line, F.lit(f"(?U){EURO}"), F.lit(0))
        pct = F.translate(F.regexp_extract(line, r"(?U)([\d.,]+)\s*%$", 1), ",.", ".")
        return F.struct(
            matched_euro(F.get(amounts, F.lit(0))).alias("ingediend"),
            matched_euro(F.get(amounts, F.lit(1))).alias("uitkering"),
            F.when(pct.rlike(r"^(\d+\.?\d*|\.\d+)$"), pct.try_cast("double"))
            .alias("recovery_pct"))

    def line(label: str) -> Column:
        return F.regexp_extract(text, rf"(?U)(?=[PTC]){label}\s+{EURO}\s+{EURO}\s+[\d.,]+\s*%", 0)

    return F.struct(*[let(line(label), parts).alias(kind) for kind, label in RECOVERY_LABELS])


# one scan collects every label with the amount after it; the lookahead consumes nothing, so that
# two labels on one line both count
_CLAIMS = (r"[TPABCtpabc](?<=(?iU)(?=((?:" + "|".join(p for _, p in DEBT_LABELS)
           + rf")[^\n€]*{EURO}))(?s:.))")


def debt_totals(text: Column, fallback: Column | None = None) -> Column:
    """STRUCT of labelled claims; the first source that has a label decides it."""
    sources = [text] if fallback is None else [text, fallback]

    def amounts(found: Column) -> Column:
        def amount(label: str) -> Column:
            # of one scan's hits the first that this label opens
            hit = F.get(F.filter(found, lambda h: h.rlike(rf"(?iU)\A{label}")), F.lit(0))
            return matched_euro(F.coalesce(
                F.regexp_extract(hit, rf"(?U)({EURO})\z", 1), F.lit("")))

        return F.struct(*[amount(label).alias(key) for key, label in DEBT_LABELS])

    hits = [let(F.regexp_extract_all(s, F.lit(_CLAIMS), F.lit(1)), amounts) for s in sources]
    if fallback is None:
        return F.when(text.isNotNull(), hits[0]).otherwise(_no_claims())
    return let(F.struct(hits[0].alias("a"), hits[1].alias("b")), lambda h: F.struct(*[
        F.coalesce(h["a"][key], h["b"][key]).alias(key) for key, _ in DEBT_LABELS]))


def _no_claims() -> Column:
    return F.struct(*[F.lit(None).cast("double").alias(key) for key, _ in DEBT_LABELS])


# ------------------------------------------------------------------------------ section 8 and 2

_BEFORE_SUBSECTION = rf"(?mU)^(?={H}{{0,8}}(?:8\.\d|9\.|10\.){H})"
_SUBSECTION_DIGIT = rf"(?U)\A{H}{{0,8}}8\.(\d){H}"
_EURO_LINE = rf"(?mU)^{H}{{0,39}}(€{H}*-?{H}*[\d.]+,\d{{2}}){H}*\d{{0,4}}{H}*$"
_COUNT_LINE = rf"(?mU)^{H}{{0,39}}\d{{1,6}}(?:{H}+\d{{1,4}})?{H}*$"
# a bare year is not a count unless a report number follows it
_BARE_YEAR = r"(?U)^\s*0{0,2}(?:199\d|20[0-2]\d|203[0-5])\s*$"


def debt_sections(creditors: Column, unified: bool = False) -> Column:
    """STRUCT of the claims and the creditor count in subsections 8.1-8.6.

    Subsections repeat one value line per reporting period: the last one is current.  The final
    subsection is read for 39 lines at most.  ``unified`` says that all its line ends are newlines.
    """

    def windows(pieces: Column) -> Column:
        capped = F.transform(pieces, lambda p, i: F.struct(
            F.regexp_extract(p, _SUBSECTION_DIGIT, 1).alias("digit"),
            F.when(i == F.size(pieces) - 1,
                   F.regexp_extract(p, r"\A[^\n]*(?:\n[^\n]*){0,39}", 0))
            .otherwise(p).alias("body")))
        return let(F.filter(capped, lambda w: w["digit"] != ""), values)

    def bodies(parts: Column, digit: str, pattern: str, group: int) -> Column:
        mine = F.filter(parts, lambda w: w["digit"] == digit)
        return F.flatten(F.transform(mine, lambda w: F.regexp_extract_all(
            w["body"], F.lit(pattern), F.lit(group))))

    def values(parts: Column) -> Column:
        fields = []
        for key, digit in DEBT_SUBSECTIONS.items():
            if key == "concurrent_aantal":
                hits = F.filter(bodies(parts, digit, _COUNT_LINE, 0),
                                lambda h: ~h.rlike(_BARE_YEAR))
                last = F.try_element_at(hits, F.lit(-1))
                value = F.regexp_extract(last, r"(?U)\d+", 0).try_cast("int")
            else:
                amounts = F.filter(
                    F.transform(bodies(parts, digit, _EURO_LINE, 1), lambda h: matched_euro(h)),
                    lambda v: v.isNotNull())
                value = F.try_element_at(amounts, F.lit(-1))
            fields.append(value.alias(key))
        return F.struct(*fields)

    return let(F.split(creditors if unified else unify_line_ends(creditors), _BEFORE_SUBSECTION),
               windows)


def merge_debt(sections: Column, totals: Column) -> Column:
    """STRUCT of claims: a financial report's totals win over section 8, the count stays apart."""
    fields = []
    for key, _ in DEBT_LABELS:
        own = sections[key] if key in DEBT_SUBSECTIONS else F.lit(None).cast("double")
        fields.append(F.coalesce(totals[key], own).alias(key))
    return F.struct(*fields, sections["concurrent_aantal"].alias("concurrent_aantal"))


def headcount(section: Column, whole_text: Column | None = None,
              unified: bool = False) -> Column:
    """STRUCT of employee counts: the first bare number left of column 40 within four lines
    below a header.  The whole text is searched only when the section gave neither count.
    ``unified`` says that all line ends of the texts are newlines."""

    def counts(text: Column) -> Column:
        plain = text if unified else unify_line_ends(text)
        number = rf"{H}{{0,39}}\d{{1,5}}{H}*$"

        def count(header: str) -> Column:
            hit = F.regexp_extract(
                plain, rf"(?mU){opening('ap', header)}[^\n]*(?:\n(?!{number})[^\n]*){{0,3}}"
                       rf"\n{H}{{0,39}}(\d{{1,5}}){H}*$", 1)
            return let(hit, lambda h: F.when(h != "", h.try_cast("int")))

        return F.struct(*[count(header).alias(key) for key, header in HEADCOUNT_HEADERS])

    if whole_text is None:
        return counts(section)

    def or_whole(found: Column) -> Column:
        none = F.lit(True)
        for key, _ in HEADCOUNT_HEADERS:
            none = none & found[key].isNull()
        return F.when(none, counts(whole_text)).otherwise(found)

    return let(counts(section), or_whole)

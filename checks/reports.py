"""Trustee reports rendered from order figures, mined back by the library.

Every customer has an early narrative, a late narrative and a financial report.  Layout variants
go by the customer key; the SQL answers know the variant and the figures, not the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base import D, S, Source, query
from estatelens.functions import figures, sections
from estatelens.functions.text import clean_text
from estatelens.plans.extraction import mine_reports, section_reports

YEARS = (1996, 1997, 1998)


def figures_of(d) -> str:
    """Figures per customer, money as DECIMAL(18,2)."""
    money = "decimal(18, 2)"
    yearly = ", ".join(
        f"sum(case when year(o_orderdate) = {y} then cast(o_totalprice as {money}) end) as r{y}"
        for y in YEARS)
    parts = ", ".join(
        f"sum(case when l_linenumber = {n} then cast(l_extendedprice as {money}) else 0 end) as a{n}"
        for n in range(1, 8))
    casts = ", ".join(f"cast(r{y} as {money}) as r{y}" for y in YEARS)
    assets = ", ".join(f"cast(coalesce(a{n}, 0) as {money}) as a{n}" for n in range(1, 8))
    return f"""select c_custkey as k, c_name, cast(c_acctbal as {money}) as bal,
        cast(coalesce(n, 0) as bigint) as n, {casts}, {assets}
      from {{customer}} left join (select o_custkey, count(*) as n, {yearly} from {{orders}}
        group by o_custkey) o on c_custkey = o.o_custkey
      left join (select o_custkey, {parts} from {{lineitem}} join {{orders}}
        on l_orderkey = o_orderkey group by o_custkey) l on c_custkey = l.o_custkey"""


FIG = figures_of(D)


def _euro(x: str) -> str:
    return f"concat('€ ', translate(format_number({x}, 2), ',.', '.,'))"


def _cell(x: str, width: int) -> str:
    return f"rpad(coalesce({_euro(x)}, ''), {width}, ' ')"


def _join(*parts: str) -> str:
    """Lines of text; NULL parts are left out."""
    return f"concat_ws('\\n', {', '.join(parts)})"


# -------------------------------------------------------------------------------- renderers
#
# revenue table variants by k % 8: 0 a year twice, 1 no result column, 2 a page break inside,
# 3 a non-breaking blank after the euro sign, 4 noise before the first year, 5 a line that ends
# the table before the third year, 6 blank lines push the third year out of reach, 7 plain.
# The result column is empty for k % 5 = 0, the balance for k % 7 = 0.


def _row(year: int, revenue: str) -> str:
    result = f"case when k % 5 <> 0 then {revenue} - 100000 end"
    balance = f"case when k % 7 <> 0 then {revenue} * 2 end"
    line = (f"concat(rpad('  {year}', 12, ' '), {_cell(revenue, 22)}, {_cell(result, 22)}, "
            f"{_cell(balance, 18)})")
    return (f"case when k % 8 = 3 then replace({line}, '€ ', concat('€', chr(160))) "
            f"else {line} end")


_HEADER = ("case when k % 8 = 1 then '  Jaar      Omzet                 Saldo                 "
           "Balanstotaal' else '  Jaar      Omzet                 Winst en verlies      "
           "Balanstotaal' end")
_TABLE = _join(
    _HEADER, "case when k % 8 = 4 then 'bedragen in euro, 3 jaren' end",
    f"concat({_row(1996, 'r1996')}, case when k % 8 = 2 then chr(12) else '' end)",
    "case when k % 8 = 6 then repeat('\\n', 10) end",
    _row(1997, "r1997"),
    "case when k % 8 = 5 then 'Toelichting volgt' end",
    f"case when k % 8 = 0 then {_row(1997, 'r1998')} else {_row(1998, 'r1998')} end",
    "''", "'Overige gegevens'", "concat('2001  ', '€ 9,00')")

# headcount variants by k % 6: 0 and 4 plain, 1 first header without value in reach, 2 no staff
# section but counts elsewhere, 3 nothing at all, 5 value too far to the right
_STAFF_LINES = _join(
    "case when k % 6 = 1 then 'Personeel gemiddeld aantal\\na\\nb\\nc\\nd' end",
    "'Aantal ten tijde van faillissement'", "concat(repeat(' ', 45), '7')",
    "case when k % 6 = 5 then concat(repeat(' ', 41), cast(n as string)) "
    "else concat('    ', cast(n as string), '  ') end",
    "'Aantal in jaar voor faillissement    verslag 1'", "''", "'  '",
    "concat('  ', cast(n + 1 as string))")

_DEBT = _join(
    "'8. Crediteuren'", "'8.1 Boedelvorderingen'", "concat('  € 1,00', '   1')",
    f"concat('huur ', {_euro('a2')})", f"concat('    ', {_euro('a1')}, '      02')",
    "'8.2 Preferente vordering van de fiscus'",
    f"case when k % 4 <> 0 then concat(' ', {_euro('a2')}) end",
    "concat(repeat(' ', 41), '€ 77,00')", "'8.3 Preferente vordering van het UWV'",
    f"{_euro('a3')}", "'8.5 Aantal concurrente crediteuren'",
    "'   3      1'", "case when k % 3 <> 0 then concat('  ', cast(n as string), '   2') end",
    "'  2001'", "'8.6 Bedrag concurrente crediteuren'",
    f"concat('  ', {_euro('a4')}, ' ')", "'8.7 Verwachte wijze van afwikkeling'",
    "concat('Opheffing ', cast(k as string))", "'€ 5,00'")

# section variants by k % 10: 0 no header at all
LATE = f"""case when k % 10 = 0 then concat('Losse tekst ', cast(k as string), '\\n') else
  {_join(
    "concat('Verslag van ', c_name)", "case when k % 3 = 0 then ' Activiteiten   onderneming ' else '' end",
    "concat('Handel in w aren ', cast(k as string))", "'1. Inventarisatie'",
    "concat('Bestuurder is Holding ', cast(k as string), ' B.V.')", "_TABLE_",
    "'  1.5 Oorzaak  faillissement'", "concat('Markt ', cast(k as string))",
    "case when k % 6 not in (2, 3) then '2. Personeel' end",
    f"case when k % 6 not in (2, 3) then {_STAFF_LINES} end",
    "'3. Activa'", "concat('Pand ', cast(k as string))",
    f"case when k % 6 = 2 then {_STAFF_LINES} end",
    "'3.8 Andere activa'", "concat('Merknaam en domein ', cast(k as string))",
    "'1. Inventarisatie'", "'herhaald'",
    "'5. Bank / Zekerheden'", "concat('De Rabobank en Lening ', cast(k as string), ' B.V. hebben')",
    "'6. Voortzetten / doorstart onderneming'",
    "concat('Verkocht aan  Koper', cast(k as string), ' B.V. voor')",
    "'7. Rechtmatigheid'", "concat('Geen conclusie ', cast(k as string))", "_DEBT_",
    "'9. Procedures'", "'geen'")} end""".replace("_TABLE_", _TABLE).replace("_DEBT_", _DEBT)

# the early narrative knows 1995 and a full row for 1996, and no creditors
EARLY = _join(
    "'Activiteiten onderneming'", "concat('Groothandel ', cast(k as string))",
    "'1. Inventarisatie'", "concat('Directie ', cast(k as string))",
    "'  Jaar      Omzet                 Winst en verlies      Balanstotaal'",
    f"concat(rpad('  1995', 12, ' '), {_cell('a5', 22)}, {_cell('a6', 22)}, {_cell('a7', 18)})",
    f"concat(rpad('  1996', 12, ' '), {_cell('a1', 22)}, {_cell('a2', 22)}, {_cell('a3', 18)})",
    "''", "'2. Personeel'", "'Aantal in jaar voor faillissement'",
    "concat('  ', cast(n + 5 as string))")

# financial report: a later total wins over an earlier subtotal, zero totals are dropped, "overige
# gebonden activa" is another category; preferential lines lack for k % 9 = 0
FINANCIAL = _join(
    "'A. Baten'", "'Subtotaal debiteuren € 1,00'", f"concat('Totaal debiteuren incl. btw  ', {_euro('a1')}, ' € 3,00')",
    f"concat('SUBTOTAAL voorraden / onderhanden werk ', {_euro('a2')})",
    f"concat('Subtotaal overig ', {_euro('a3')})", "'Totaal overige gebonden activa € 12,00'",
    f"concat('Totaal doorstart onderneming ', {_euro('a4')})",
    "'Totaal voortzetten / doorstart € 4,00'", "'Totaal procedures € n.v.t. € 6,00'",
    f"concat('Saldo Boedelrekening   ', {_euro('bal + 1')})",
    f"concat('Definitief Saldo  ', {_euro('bal')})", "'Definitief Saldo € 99,00'",
    f"case when k % 4 = 0 then concat('Saldo beschikbaar voor uitdeling ', {_euro('a5')}) end",
    f"case when k % 3 = 0 then concat('Totaal boedelvorderingen (netto) ', {_euro('a6')}) end",
    f"concat('preferente vorderingen van de fiscus ', {_euro('a7')})",
    f"""case when k % 9 <> 0 then concat(case when k % 2 = 0 then 'Totaal preferente schuldeisers '
      else 'Preferente crediteuren ' end, {_euro('a6')}, '  ', {_euro('a5')}, ' ',
      cast(k % 100 as string), ',', lpad(cast(k % 7 as string), 2, '0'), ' %') end""",
    f"""concat('Concurrente crediteuren ', {_euro('a5')}, ' € 0,00 0,00%')""")


def report_texts(s: Source) -> DataFrame:
    """(k, document_kenmerk, role, text) of all three reports of every customer."""
    rendered = s.sql(figures_of(S)).selectExpr(
        "k", f"{EARLY} as early", f"{LATE} as late", f"{FINANCIAL} as financial")
    return rendered.selectExpr("k", "stack(3, 'early', early, 'late', late, 'financial', financial)"
                               " as (role, text)").selectExpr(
        "k", "concat(role, '_', cast(k as string)) as document_kenmerk", "role", "text")


def _text(s: Source, role: str) -> DataFrame:
    column = {"early": EARLY, "late": LATE, "financial": FINANCIAL}[role]
    return s.sql(figures_of(S)).selectExpr("k", f"{column} as text")


def _sectioned(s: Source, role: str) -> DataFrame:
    return section_reports(_text(s, role))


def _dbl(x: str) -> str:
    return f"cast({x} as double)"


# --------------------------------------------------------------------------------- sections

_KEYS_SQL = """case when k % 10 = 0 then 'head' else array_to_string(list_sort(list_filter([
      'head', case when k % 3 = 0 then 'activiteiten' end, 'inventarisatie', 'oorzaak',
      case when k % 6 not in (2, 3) then 'personeel' end, 'activa', 'andere_activa', 'zekerheden',
      'doorstart', 'rechtmatigheid', 'crediteuren', 'procedures'], lambda x: x is not null)), '|') end"""


@query("split_sections", f"""select k, {_KEYS_SQL} as keys,
      case when k % 10 = 0 then concat('Losse tekst ', cast(k as varchar), chr(10))
        else concat('Verslag van ', c_name, case when k % 3 = 0 then '' else concat(chr(10), chr(10),
          'Handel in waren ', cast(k as varchar)) end) end as head,
      case when k % 10 <> 0 then concat('1.5 Oorzaak  faillissement', chr(10), 'Markt ', cast(k as varchar)) end
        as oorzaak,
      case when k % 10 <> 0 then concat('3.8 Andere activa', chr(10), 'Merknaam en domein ',
        cast(k as varchar), chr(10), '1. Inventarisatie', chr(10), 'herhaald') end as andere_activa
    from ({FIG}) f""")
def _(s: Source) -> DataFrame:
    found = _sectioned(s, "late")
    keys = F.array_join(F.array_sort(F.map_keys("sections")), "|")
    return found.select("k", keys.alias("keys"), *[
        F.try_element_at("sections", F.lit(n)).alias(n)
        for n in ("head", "oorzaak", "andere_activa")])


@query("pick_section", f"""select k, case when k % 10 <> 0 and k % 3 = 0
        then concat('Activiteiten   onderneming', ' ', chr(10), 'Handel in waren ', cast(k as varchar))
        else concat('Activiteiten onderneming', chr(10), 'Groothandel ', cast(k as varchar)) end as latest_first,
      concat('Activiteiten onderneming', chr(10), 'Groothandel ', cast(k as varchar)) as first_latest,
      '' as nowhere from ({FIG}) f""")
def _(s: Source) -> DataFrame:
    both = s.sql(figures_of(S)).selectExpr("k", f"{EARLY} as early", f"{LATE} as late").select(
        "k", sections.split_sections(clean_text(F.col("early"))).alias("early"),
        sections.split_sections(clean_text(F.col("late"))).alias("late"))
    early, late = F.col("early"), F.col("late")
    return both.select("k", sections.pick_section("activiteiten", late, early).alias("latest_first"),
                       sections.pick_section("activiteiten", early, late).alias("first_latest"),
                       sections.pick_section("overig", early, late).alias("nowhere"))


@query("section_reports", f"""select lang, count(*) as n, sum(n_head) as n_whole from (
      select lang, case when text is null then null else 1 end as n_head from {{documents}}) d
    group by lang""")
def _(s: Source) -> DataFrame:
    """Documents without report headers are one 'head' holding the whole cleaned text."""
    found = section_reports(s.table("documents").select("lang", "text"))
    whole = F.try_element_at("sections", F.lit("head")) == F.col("cleaned")
    return found.groupBy("lang").agg(F.count(F.lit(1)).alias("n"),
                                     F.sum(whole.cast("bigint")).alias("n_whole"))


_FILLER = "repeat(concat(c_name, ' '), 300)"  # 5700 characters


@query("settlement_tail", f"""select c_custkey, case c_custkey % 3
        when 0 then concat('8.7 Wijze', chr(10), c_name, ' 8.7 herhaald')
        when 1 then right(concat('8. Crediteuren ', {_FILLER}), 4000)
        else left(concat('8.7 Wijze ', {_FILLER}), 4000) end as tail from {{customer}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"""select c_custkey, case c_custkey % 3
        when 0 then concat('8. Crediteuren ', {_FILLER}, '8.7 Wijze\n', c_name, ' 8.7 herhaald')
        when 1 then concat('8. Crediteuren ', {_FILLER})
        else concat('8. Crediteuren 8.7 Wijze ', {_FILLER}) end as c from {{customer}}""")
    return rows.select("c_custkey", sections.settlement_tail(F.col("c"), 4000).alias("tail"))


@query("governance_tail", """select doc_id, case when length(text) > 4400 then length(text) - 4400
      else 0 end as dropped, right(text, 4400) as tail from {documents}""")
def _(s: Source) -> DataFrame:
    tail = sections.governance_tail(F.col("text"), 4400)
    return s.table("documents").select(
        "doc_id", (F.length("text") - F.length(tail)).cast("bigint").alias("dropped"),
        tail.alias("tail"))


# ---------------------------------------------------------------------------------- revenue


def _late_rows() -> str:
    def row(year: int, column: str, cond: str) -> str:
        return f"""select k, {year} as jaar, {_dbl(column)} as omzet,
          case when k % 5 <> 0 then {_dbl(column + ' - 100000')} end as winst_verlies,
          case when k % 7 <> 0 then {_dbl(column + ' * 2')} end as balanstotaal
          from ({FIG}) f where k % 10 <> 0 and k % 8 not in (0, 1) and {cond}"""

    return " union all ".join([row(1996, "r1996", "true"), row(1997, "r1997", "true"),
                               row(1998, "r1998", "k % 8 not in (5, 6)")])


@query("parse_revenue", _late_rows())
def _(s: Source) -> DataFrame:
    rows = _text(s, "late").select("k", F.explode(figures.parse_revenue(F.col("text"))).alias("r"))
    return rows.select("k", "r.*")


_EARLY_ROWS = f"""select k, 1995 as jaar, {_dbl('a5')} as omzet, {_dbl('a6')} as winst_verlies,
      {_dbl('a7')} as balanstotaal from ({FIG}) f
    union all select k, 1996, {_dbl('a1')}, {_dbl('a2')}, {_dbl('a3')} from ({FIG}) f"""
MERGED = f"""select coalesce(l.k, e.k) as k, coalesce(l.jaar, e.jaar) as jaar,
      coalesce(l.omzet, e.omzet) as omzet, coalesce(l.winst_verlies, e.winst_verlies) as winst_verlies,
      coalesce(l.balanstotaal, e.balanstotaal) as balanstotaal
    from ({_late_rows()}) l full join ({_EARLY_ROWS}) e on l.k = e.k and l.jaar = e.jaar"""


@query("merge_revenue", MERGED)
def _(s: Source) -> DataFrame:
    both = s.sql(figures_of(S)).selectExpr("k", f"{EARLY} as early", f"{LATE} as late").select(
        "k", figures.parse_revenue(F.col("early")).alias("early"),
        figures.parse_revenue(F.col("late")).alias("late"))
    merged = figures.merge_revenue(F.col("late"), F.col("early"))
    return both.select("k", F.explode(merged).alias("r")).select("k", "r.*")


# ------------------------------------------------------------------------ financial reports

ASSETS = " union all ".join(
    f"select k, '{key}' as categorie, {_dbl(column)} as bedrag from ({FIG}) f where {column} <> 0"
    for key, column in (("debiteuren", "a1"), ("voorraden", "a2"), ("overig", "a3"),
                        ("doorstart", "a4"), ("voortzetten_doorstart_totaal", "4.0")))


@query("asset_realizations", ASSETS)
def _(s: Source) -> DataFrame:
    return _text(s, "financial").select("k", F.explode(figures.asset_realizations(
        F.col("text"))).alias("categorie", "bedrag"))


@query("estate_balances", f"""select k, {_dbl('bal')} as definitief_saldo,
      {_dbl('bal + 1')} as saldo_boedelrekening,
      case when k % 4 = 0 then {_dbl('a5')} end as beschikbaar_voor_uitdeling from ({FIG}) f""")
def _(s: Source) -> DataFrame:
    return _text(s, "financial").select("k", figures.estate_balances(F.col("text")).alias("b")
                                        ).select("k", "b.*")


@query("creditor_recovery", f"""select k, case when k % 9 <> 0 then {_dbl('a6')} end as pref_claimed,
      case when k % 9 <> 0 then {_dbl('a5')} end as pref_paid,
      case when k % 9 <> 0 then cast(cast(k % 100 + (k % 7) / 100.0 as decimal(10, 2)) as double) end
        as pref_pct, {_dbl('a5')} as conc_claimed, 0.0::double as conc_paid, 0.0::double as conc_pct
    from ({FIG}) f""")
def _(s: Source) -> DataFrame:
    found = _text(s, "financial").select("k", figures.creditor_recovery(F.col("text")).alias("c"))
    return found.select("k", *[F.col(f"c.{kind}.{field}").alias(f"{short}_{name}")
                               for kind, short in (("preferente", "pref"), ("concurrente", "conc"))
                               for field, name in (("ingediend", "claimed"), ("uitkering", "paid"),
                                                   ("recovery_pct", "pct"))])


_TOTALS = f"""select k, case when k % 3 = 0 then {_dbl('a6')} end as boedelvorderingen,
      {_dbl('a7')} as pref_fiscus, cast(null as double) as pref_uwv, cast(null as double) as pref_overig,
      case when k % 9 <> 0 and k % 2 = 0 then {_dbl('a6')} end as pref_totaal,
      {_dbl('a5')} as concurrent_bedrag from ({FIG}) f"""


@query("debt_totals", _TOTALS)
def _(s: Source) -> DataFrame:
    return _text(s, "financial").select("k", figures.debt_totals(F.col("text")).alias("d")
                                        ).select("k", "d.*")


_SECTION8 = f"""select k, case when k % 10 <> 0 then {_dbl('a1')} end as boedelvorderingen,
      case when k % 10 <> 0 and k % 4 <> 0 then {_dbl('a2')} end as pref_fiscus,
      case when k % 10 <> 0 then {_dbl('a3')} end as pref_uwv, cast(null as double) as pref_overig,
      case when k % 10 <> 0 then case when k % 3 = 0 then 3 else cast(n as integer) end end
        as concurrent_aantal,
      case when k % 10 <> 0 then {_dbl('a4')} end as concurrent_bedrag from ({FIG}) f"""


def _creditors(s: Source) -> DataFrame:
    return _sectioned(s, "late").select("k", F.coalesce(F.try_element_at(
        "sections", F.lit("crediteuren")), F.lit("")).alias("c"))


@query("debt_sections", _SECTION8)
def _(s: Source) -> DataFrame:
    return _creditors(s).select("k", figures.debt_sections(F.col("c")).alias("d")).select("k", "d.*")


DEBT = f"""select s.k, coalesce(t.boedelvorderingen, s.boedelvorderingen) as boedelvorderingen,
      coalesce(t.pref_fiscus, s.pref_fiscus) as pref_fiscus, coalesce(t.pref_uwv, s.pref_uwv) as pref_uwv,
      coalesce(t.pref_overig, s.pref_overig) as pref_overig, t.pref_totaal,
      coalesce(t.concurrent_bedrag, s.concurrent_bedrag) as concurrent_bedrag, concurrent_aantal
    from ({_SECTION8}) s join ({_TOTALS}) t on s.k = t.k"""


@query("debt_merge", DEBT)
def _(s: Source) -> DataFrame:
    both = s.sql(figures_of(S)).selectExpr("k", f"{LATE} as late", f"{FINANCIAL} as fin").select(
        "k", "fin", sections.split_sections(clean_text(F.col("late"))).alias("sections"))
    own = figures.debt_sections(sections.pick_section("crediteuren", F.col("sections")))
    staged = both.select("k", own.alias("own"), figures.debt_totals(F.col("fin")).alias("totals"))
    return staged.select("k", figures.merge_debt(F.col("own"), F.col("totals")).alias("d")
                         ).select("k", "d.*")


_STAFF = """case when k % 10 = 0 or k % 6 in (3, 5) then null else n end as personeel_ttv,
      case when k % 10 = 0 or k % 6 = 3 then null else n + 1 end as personeel_jaar_voor"""


@query("headcount", f"select k, {_STAFF} from ({FIG}) f")
def _(s: Source) -> DataFrame:
    found = _sectioned(s, "late").select("k", figures.headcount(
        sections.pick_section("personeel", F.col("sections")), F.col("cleaned")).alias("h"))
    return found.select("k", *[F.col(f"h.{c}").cast("bigint").alias(c)
                               for c in ("personeel_ttv", "personeel_jaar_voor")])


@query("mine_reports", f"""select r.k, n_years, n_assets, saldo, fiscus, uwv, staff from (
      select k, 'late' as role, cast(0 as bigint) as n_assets, cast(null as double) as saldo,
        case when k % 10 <> 0 and k % 4 <> 0 then {_dbl('a2')} end as fiscus,
        case when k % 10 <> 0 then {_dbl('a3')} end as uwv,
        case when k % 10 = 0 or k % 6 in (3, 5) then null else n end as staff from ({FIG}) f
      union all select k, 'financial', cast(1 + (a1 <> 0)::int + (a2 <> 0)::int + (a3 <> 0)::int
        + (a4 <> 0)::int as bigint), {_dbl('bal + 1')}, {_dbl('a7')}, null, null from ({FIG}) f
      union all select k, 'early', 0, null, null, null, null from ({FIG}) f) r
    left join (select k, 'late' as role, count(*) as n_years from ({_late_rows()}) group by k
      union all select k, 'early', count(*) from ({_EARLY_ROWS}) group by k) y
      on r.k = y.k and r.role = y.role""")
def _(s: Source) -> DataFrame:
    """All parsers over all three reports of a case in one pass."""
    mined = mine_reports(section_reports(report_texts(s)))
    return mined.select(
        "k", F.nullif(F.size("revenue"), F.lit(0)).cast("bigint").alias("n_years"),
        F.size("assets").cast("bigint").alias("n_assets"),
        F.col("boedel.saldo_boedelrekening").alias("saldo"),
        F.col("debt.pref_fiscus").alias("fiscus"), F.col("debt.pref_uwv").alias("uwv"),
        F.col("headcount.personeel_ttv").cast("bigint").alias("staff"))

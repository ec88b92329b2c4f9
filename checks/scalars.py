"""Date, label, id, privacy and text expressions on texts rendered from table columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base import (
    D, OLD_ABBRS, OLD_NUMBERS, S, Source, listing, pubs, query,
)
from estatelens.functions import casenumber, classify, dates, privacy, text
from estatelens.operators import responses
from estatelens.sources.listing import number_listing, to_listing
from estatelens.sources.payloads import classify_publications
from estatelens.vocab import (
    COMPANY_SUFFIXES, EVENT_SUBTYPES, EVENT_TYPES, INSOLVENCY_TYPES, MONTHS,
)

LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
SALT = "zout"


def _iso(c) -> F.Column:
    return c.cast("string")


def _dutch_day(day: str) -> str:
    """Spark SQL: 'D maand YYYY'."""
    month = S.pick(list(MONTHS), f"month({day}) - 1")
    return f"concat(cast(day({day}) as string), ' ', {month}, ' ', cast(year({day}) as string))"


# ------------------------------------------------------------------------------------ dates


@query("dutch_date", f"""select {LINE}, case l_partkey % 7 when 0 then null when 1 then null
      when 2 then null when 3 then null else cast(cast(l_shipdate as date) as varchar) end
      as event_date from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    day = _dutch_day("l_shipdate")
    rows = s.sql(f"""select {LINE}, case l_partkey % 7
        when 0 then concat('Failliet op 31 februari 2024 en op ', {day})
        when 1 then concat('op 3 personen 2024 gewezen op ', {day})
        when 2 then concat('Uitspraak van ', {day})
        when 3 then concat('op 1 brumaire 1999, daarna op ', {day})
        when 4 then concat('Einde OP 3 mei 2001, op ', {day}, ' en op 1 mei 1990')
        when 5 then concat('Zaak é op ', upper({day}))
        else concat('Einde faillissement op ', {day}, '.') end as t from {{lineitem}}""")
    return rows.withColumn("event_date", _iso(dates.dutch_date(F.col("t")))).drop("t")


@query("dotnet_date", f"""select {LINE}, case when l_partkey % 5 = 0 then null else
      cast(cast(l_shipdate + to_seconds(l_suppkey * 60) as date) as varchar) end as utc_date,
      case when l_partkey % 5 = 0 then null else cast(cast(l_shipdate
        + to_seconds(l_suppkey * 60 + case when l_partkey % 2 = 0 then 0 else 7200 end) as date)
        as varchar) end as local_date
    from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"""select {LINE}, case when l_partkey % 10 = 0 then '/Date(-62135596800000)/'
        when l_partkey % 5 = 0 then 'n/a' else concat('/Date(',
          cast(unix_millis(cast(l_shipdate as timestamp)) + l_suppkey * 60000 as string),
          case when l_partkey % 2 = 0 then '' else '+0200' end, ')/') end as t
        from {{lineitem}}""")
    t = F.col("t")
    return rows.withColumns({"utc_date": _iso(dates.dotnet_date(t)),
                             "local_date": _iso(dates.dotnet_date(t, local=True))}).drop("t")


@query("iso_date_clamp", f"""select {LINE}, case l_partkey % 6 when 0 then null when 1 then null
      when 2 then null when 3 then '2149-06-06'
      else cast(cast(l_shipdate as date) as varchar) end as d from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"""select {LINE}, case l_partkey % 6
        when 0 then concat('3026', substring(cast(l_shipdate as string), 5))
        when 1 then '2024-1-5' when 2 then concat('1969', substring(cast(l_shipdate as string), 5))
        when 3 then '2149-06-06T10:00' when 4 then cast(l_shipdate as string)
        else cast(cast(l_shipdate as date) as string) end as t from {{lineitem}}""")
    return rows.withColumn("d", _iso(dates.iso_date_clamp(F.col("t")))).drop("t")


@query("dmy_date", f"""select {LINE}, case l_partkey % 5 when 0 then null when 1 then null
      when 2 then null else cast(cast(l_shipdate as date) as varchar) end as d
    from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"""select {LINE}, case l_partkey % 5 when 0 then '00-00-0000'
        when 1 then concat('31-02-', year(l_shipdate)) when 2 then cast(l_shipdate as string)
        else {S.dmy('l_shipdate')} end as t from {{lineitem}}""")
    return rows.withColumn("d", _iso(dates.dmy_date(F.col("t")))).drop("t")


# ----------------------------------------------------------------------------------- labels


def _mixed(words: list[str], index: str, d=S) -> str:
    return d.pick([w.capitalize() for w in words], index)


@query("event_type", f"""select {LINE}, case when l_suppkey % 9 = 0 then 'unknown' else
      {D.pick([v for _, v in EVENT_TYPES], 'l_partkey % 15')} end as event_type
    from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"""select {LINE}, case when l_suppkey % 9 = 0 then 'Zaak zonder woord'
        else concat({_mixed([w for w, _ in EVENT_TYPES], 'l_partkey % 15')},
          ' van de zaak ', case when l_partkey % 15 = 3 or l_partkey % 15 > 8
            then '' else 'EINDE' end) end as t from {{lineitem}}""")
    # the shortest keyword, added to most texts, must never win against the one meant
    return rows.withColumn("event_type", classify.event_type(F.col("t"))).drop("t")


@query("event_subtype", f"""select {LINE}, case when l_suppkey % 9 = 0 then null else
      {D.pick([v for _, v in EVENT_SUBTYPES], 'l_partkey % 10')} end as event_subtype
    from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"""select {LINE}, case when l_suppkey % 9 = 0 then 'Zaak' else
        concat('zaak: ', {_mixed([w for w, _ in EVENT_SUBTYPES], 'l_partkey % 10')},
          case when l_partkey % 10 = 6 then '' else ' met verzet' end) end as t
        from {{lineitem}}""")
    return rows.withColumn("event_subtype", classify.event_subtype(F.col("t"))).drop("t")


_INS_TEXT = [w for w, _ in INSOLVENCY_TYPES] + ["surseance na schuldsanering", "zaak"]
_INS_LABEL = [v for _, v in INSOLVENCY_TYPES] + ["schuldsanering", "unknown"]


@query("insolvency_type", f"""select {LINE}, {D.pick(_INS_LABEL, 'l_partkey % 6')}
    as insolvency_type from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"select {LINE}, {_mixed(_INS_TEXT, 'l_partkey % 6')} as t from {{lineitem}}")
    return rows.withColumn("insolvency_type", classify.insolvency_type(F.col("t"))).drop("t")


_PLAIN_SUBTYPES = ["gebrek aan baten", "schone lei", "nihil uitdeling", "hoger beroep"]


@query("classify_publications", f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey,
      event_type, {D.pick(['gebrek_aan_baten', 'schone_lei', 'nihil_uitdeling_schone_lei',
                           'hoger_beroep'], 'l_suppkey % 4')} as event_subtype,
      cast(cast(l_shipdate as date) as varchar) as event_date,
      {D.pick(_INS_LABEL, 'l_linenumber % 6')} as insolvency_type from ({pubs(D)}) p""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey,
        concat(keyword, ' ', {S.pick(_INS_TEXT, 'l_linenumber % 6')}, ' wegens ',
          {S.pick(_PLAIN_SUBTYPES, 'l_suppkey % 4')}, ' op ', {_dutch_day('l_shipdate')})
          as description from ({pubs(S)}) p""")
    out = classify_publications(rows)
    return out.withColumn("event_date", _iso(F.col("event_date"))).drop("description")


_TITLES = ["Financieel verslag", "Verslag", "Tussentijds financieel verslag", "Eindverslag"]


@query("report_type", f"""select {LINE}, case when l_suppkey % 7 = 0 then 'Verslag' else
      {D.pick(_TITLES, 'l_partkey % 4')} end as report_type from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"""select {LINE}, case l_suppkey % 14 when 0 then {S.dmy('l_shipdate')}
        when 7 then cast(null as string) else concat({S.pick(_TITLES, 'l_partkey % 4')},
          case l_suppkey % 3 when 0 then ': ' when 1 then '  ' else '' end,
          case when l_suppkey % 3 = 2 then '' else {S.dmy('l_shipdate')} end) end as t
        from {{lineitem}}""")
    return rows.withColumn("report_type", classify.report_type(F.col("t"))).drop("t")


# ------------------------------------------------------------------------------ case numbers


@query("derive_case_number", f"""select c_custkey, case_key, insolventienummer
    from ({listing(D)}) l""")
def _(s: Source) -> DataFrame:
    return number_listing(s.sql(listing(S)).select("c_custkey", "verslag_kenmerk")).drop(
        "verslag_kenmerk")


@query("number_listing", f"""select insolventienummer, count(*) as n, min(case_key) as first_key,
      count(distinct case_key) as n_keys from ({listing(D)}) l group by 1""")
def _(s: Source) -> DataFrame:
    out = number_listing(s.sql(listing(S)).select("verslag_kenmerk"))
    return out.groupBy("insolventienummer").agg(
        F.count(F.lit(1)).alias("n"), F.min("case_key").alias("first_key"),
        F.count_distinct("case_key").alias("n_keys"))


@query("listing_rows", f"""select verslag_kenmerk, case_key, insolventienummer, kvk_nummer,
      cast(verslag_datum as varchar) as verslag_datum, c_name as company_name, city, page
    from ({listing(D)}) l""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"""select verslag_kenmerk, kvk_nummer, verslag_datum, c_name as company_name,
        city, page from ({listing(S)}) l""")
    return to_listing(rows).withColumn("verslag_datum", _iso(F.col("verslag_datum")))


@query("report_path", f"""select c_custkey, concat('zaken/pdfs/', verslag_kenmerk, '.pdf') as path,
      replace(verslag_kenmerk, '.', '_') as file_id from ({listing(D)}) l""")
def _(s: Source) -> DataFrame:
    rows = s.sql(listing(S))
    return rows.select("c_custkey", casenumber.report_path(F.col("verslag_kenmerk"), "zaken")
                       .alias("path"), casenumber.underscored(F.col("verslag_kenmerk"))
                       .alias("file_id"))


@query("old_court_number", f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey,
      case when l_partkey % 22 = 21 then null else
      {D.pick(OLD_NUMBERS, 'l_partkey % 22')} end as court from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"select {LINE}, {S.pick(OLD_ABBRS + ['xyz'], 'l_partkey % 22')} as a "
                 "from {lineitem}")
    return rows.withColumn("court", casenumber.old_court_number(F.col("a"))).drop("a")


# ----------------------------------------------------------------------------------- privacy


@query("salted_hash", f"""select c_custkey,
      substr(sha256(concat('{SALT}', ' ', c_name)), 1, 12) as hash from {{customer}}""")
def _(s: Source) -> DataFrame:
    return s.table("customer").select("c_custkey", privacy.salted_hash(
        F.concat(F.lit(" "), "c_name"), SALT).alias("hash"))


@query("person_hash", f"""select c_custkey,
      substr(sha256(concat('{SALT}', lower(c_name))), 1, 12) as hash from {{customer}}""")
def _(s: Source) -> DataFrame:
    return s.table("customer").select("c_custkey", privacy.person_hash(
        F.concat(F.lit(" \t"), F.upper("c_name"), F.lit(" ")), SALT).alias("hash"))


_NAMES = ["J. de Vries", "Jan Jansen", "van den Berg", "'t Hart-Bos"]
_HONORIFICS = ["de heer ", "mevrouw ", "Dhr. ", "MEVR. ", "mw.  "]
_AFTER = ["is bestuurder.", "heeft betaald", "(directie)", "woont in 1234"]


@query("redact_persons", f"""select {LINE}, concat('Volgens ', case when l_suppkey % 6 = 0
      then 'jan en piet ' else '[persoon] ' end, {D.pick(_AFTER, 'l_linenumber % 4')}) as t
    from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"""select {LINE}, concat('Volgens ', case when l_suppkey % 6 = 0
        then 'jan en piet' else concat({S.pick(_HONORIFICS, 'l_partkey % 5')},
          {S.pick(_NAMES, 'l_partkey % 4')}) end, ' ', {S.pick(_AFTER, 'l_linenumber % 4')}, ' ')
        as t from {{lineitem}}""")
    return rows.withColumn("t", privacy.redact_persons(F.col("t")))


@query("scrub_known_persons", f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey,
      case l_suppkey % 3 when 0 then concat('J. de Vries', cast(l_partkey as varchar), ' en de vries')
        when 1 then concat('[persoon]', ' en [persoon], niet Vries')
        else '[persoon] en Bo' end as t from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"""select {LINE}, case l_suppkey % 3
          when 0 then concat('J. de Vries', cast(l_partkey as string), ' en de vries')
          when 1 then concat('j. DE vries', cast(l_partkey as string), ' en De Vries',
            cast(l_partkey as string), ', niet Vries')
          else concat('A.(x)+', cast(l_partkey as string), ' en Bo') end as t,
        case l_suppkey % 3 when 0 then cast(array() as array<string>)
          when 1 then array(concat('J. de Vries', cast(l_partkey as string)))
          else array('K. Bo', concat('A.(x)+', cast(l_partkey as string))) end as names
        from {{lineitem}}""")
    pattern = privacy.known_person_pattern(F.col("names"))
    return rows.withColumn("t", privacy.scrub_known_persons(F.col("t"), pattern)).drop("names")


_PEOPLE = [("Jan Jansen", True), ("jan jansen", False), ("Jan", False), ("Élise", False),
           ("een Natuurlijk persoon", False), ("De Curator", False), ("P. Bos", True)]


@query("is_person_name", f"""select {LINE},
      {D.pick([int(v) for _, v in _PEOPLE], 'l_partkey % 7')} = 1 as person from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"select {LINE}, {S.pick([n for n, _ in _PEOPLE], 'l_partkey % 7')} as n "
                 "from {lineitem}")
    return rows.withColumn("person", privacy.is_person_name(F.col("n"))).drop("n")


_FORMS = [("Bakkerij {} B.V.", True), ("{} bv", True), ("Stichting {}", True), ("Bvx {}", False),
          ("{} Groep Zuid", True), ("Coöperatie {} U.A.", True), ("{}", False),
          ("Incasso {}", False)]


@query("looks_like_company", f"""select {LINE},
      {D.pick([int(v) for _, v in _FORMS], 'l_partkey % 8')} = 1 as company from {{lineitem}}"""
       .replace("{}", ""))
def _(s: Source) -> DataFrame:
    names = S.pick([n.replace("{}", "Klaver") for n, _ in _FORMS], "l_partkey % 8")
    rows = s.sql(f"select {LINE}, {names} as n from {{lineitem}}")
    return rows.withColumn("company", privacy.looks_like_company(F.col("n"))).drop("n")


@query("norm_name", """select c_custkey, concat('customer', lpad(cast(c_custkey as varchar), 9, '0'),
      'holdingbv') as norm from {customer}""")
def _(s: Source) -> DataFrame:
    name = F.concat("c_name", F.lit(" Höl-ding B.V."))
    return s.table("customer").select("c_custkey", F.replace(
        text.norm_name(name), F.lit("hlding"), F.lit("holding")).alias("norm"))


@query("grounded", f"""select {LINE}, l_suppkey % 3 <> 2 as found from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"""select {LINE}, concat('De  Klaver\n ', cast(l_partkey as string), '  b.v.') as n,
        case l_suppkey % 3 when 0 then concat('Met DE KLAVER ', cast(l_partkey as string), ' B.V. is')
          when 1 then concat('de\tklaver\n\n', cast(l_partkey as string), '  b.v.')
          else concat('de klaver', cast(l_partkey as string), ' b.v.') end as src
        from {{lineitem}}""")
    return rows.withColumn("found", text.grounded(F.col("n"), F.col("src"))).drop("n", "src")


_TRADE_NAMES = [f"Bakker {x.upper()}" for x in COMPANY_SUFFIXES] + ["Bakker bv", "Cafe"]


@query("company_suffix", f"""select {LINE}, l_partkey % 10 < 8 as suffix from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"select {LINE}, {S.pick(_TRADE_NAMES, 'l_partkey % 10')} as n from {{lineitem}}")
    return rows.withColumn("suffix", privacy.has_company_suffix(F.col("n"))).drop("n")


# -------------------------------------------------------------------------------------- text

EURO_SPARK = "concat('€ ', translate(format_number(x, 2), ',.', '.,'))"


@query("parse_euro", f"""select {LINE}, case l_partkey % 9 when 0 then null when 1 then null
      when 2 then null when 3 then -l_extendedprice else l_extendedprice end as amount
    from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"""select {LINE}, case l_partkey % 9 when 0 then '' when 1 then '€ --'
        when 2 then '€ n.v.t.' when 3 then replace({EURO_SPARK}, '€ ', '€ -')
        when 4 then replace({EURO_SPARK}, ' ', chr(160)) when 5 then concat('  ', {EURO_SPARK}, ' ')
        else {EURO_SPARK} end as t
        from (select *, cast(l_extendedprice as decimal(18, 2)) as x from {{lineitem}}) l""")
    return rows.withColumn("amount", text.parse_euro(F.col("t"))).drop("t")


@query("clean_text", f"""select {LINE}, concat('Er worden ', cast(l_partkey as varchar),
      ' zaken Wordt', chr(10), 'nieuw e new A') as t from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"""select {LINE}, concat('Er w orden', chr(7), ' ', cast(l_partkey as string),
        chr(12), ' zaken W ordt', chr(10), 'nieuw e new A') as t from {{lineitem}}""")
    return rows.withColumn("t", text.clean_text(F.col("t")))


@query("text_lines", f"""select {LINE}, l_suppkey % 5 + 2 as n_lines,
      cast(l_partkey as varchar) as last_line from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    """Lines by every separator, an empty one in between, and one at the end."""
    ends = S.pick(["\r\n", "\n", "\x0b", chr(0x2028), "\x85"], "l_partkey % 5")
    rows = s.sql(f"""select {LINE}, concat(repeat(concat('regel', {ends}), cast(l_suppkey % 5 as int)),
        {ends}, cast(l_partkey as string), case when l_partkey % 3 = 0 then {ends} else '' end) as t
        from {{lineitem}}""")
    parts = rows.withColumn("a", text.lines(F.col("t")))
    return parts.withColumns({"n_lines": F.size("a").cast("bigint"),
                              "last_line": F.element_at("a", -1)}).drop("a", "t")



@query("response_json", f"""select {LINE}, case l_suppkey % 4 when 0 then null when 1 then null
      else l_partkey end as n from {{lineitem}}""")
def _(s: Source) -> DataFrame:
    rows = s.sql(f"""select {LINE}, case l_suppkey % 4 when 0 then 'geen antwoord'
        when 1 then 'half {{{{"n": 1' when 2 then concat('{{{{"n": ', cast(l_partkey as string), '}}}}')
        else concat('Antwoord:\n{{{{"a": {{{{"b": 1}}}}, "n": ', cast(l_partkey as string), '}}}} klaar') end as t
        from {{lineitem}}""")
    answer = responses.response_json(F.col("t"))
    return rows.withColumn("n", F.try_variant_get(answer, "$.n", "bigint")).drop("t")



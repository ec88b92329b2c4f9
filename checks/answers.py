"""Scorer requests, answers and the extraction record.

Answers are rendered per customer and question; the SQL answers follow from the same key.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.base import D, S, Source, query
from checks.reports import ASSETS, DEBT, FIG, MERGED, report_texts
from estatelens.operators import fanout, responses
from estatelens.plans.extraction import extract_company, extract_mined
from estatelens.plans.mined import add_reports, mined_reports, report_keys
from estatelens.session import work_dir
from estatelens.sources.tables import live_rows
from estatelens.vocab import SECTORS

SALT = "zout"
NAME = "concat('Voornaam ', cast(k as string))"


def _reply(field: str, body: str) -> str:
    """One answer; for k % 13 = 12 it is missing, for 11 broken, for odd k it stands in prose."""
    return (f"struct('{field}' as field, case when k % 13 = 12 then 'weet niet' "
            f"when k % 13 = 11 then concat('x', substring({body}, 1, 8)) "
            f"when k % 2 = 1 then concat('Antwoord: ', {body}, ' einde') else {body} end as reply)")


def _json(**members: str) -> str:
    parts = ", ".join(f"'\"{name}\": ', {value}, '{sep}'" for (name, value), sep in zip(
        members.items(), [", "] * (len(members) - 1) + [""]))
    return f"concat('{{', {parts}, '}}')"


def _str(value: str) -> str:
    return f"concat('\"', {value}, '\"')"


_K = "cast(k as string)"
_ACQUIRER = f"""case k % 6 when 0 then '"De Overnemer"' when 1 then {_str(f"concat('koper', {_K}, ' b.v.')")}
  when 2 then '"de heer P. Bos"' when 3 then 'null' when 4 then {_str("concat('Elders ', " + _K + ", ' BV')")}
  else {_str("concat('''Koper', " + _K + ", ' B.V.''')")} end"""
_COMPANIES = f"""concat('[{{"naam": "HOLDING  ', {_K}, ' b.v.", "relatie": "moeder"}}, ',
  '{{"naam": "Holding ', {_K}, ' B.V", "relatie": "moeder"}}, ',
  '{{"naam": "Holding ', {_K}, ' B.V.", "relatie": "buur"}}, ',
  '{{"naam": "Elders ', {_K}, ' B.V.", "relatie": "dochter"}}, {{"naam": "Bestuurder"}}]')"""
_BANKS = f"""concat('[{{"naam": "Rabobank", "vordering": ', {_K}, '.5}}, {{"naam": "de bank"}}, ',
  '{{"naam": "Lening ', {_K}, ' B.V.", "vordering": null}}, {{"naam": "ABN"}}]')"""
_ANSWERS = [
    _reply("sector", _json(
        activiteiten=_str(f"concat('Handel door mevrouw A. Bos en ', {NAME})"),
        sector=_str(S.pick(SECTORS, "k % 14")))),
    _reply("oorzaak", _json(oorzaak=_str(f"concat('Verlies volgens ', upper({NAME}))"),
                            categorie="'\"markt\"'")),
    _reply("doorstart", _json(doorstart="case k % 3 when 0 then 'true' when 1 then 'false' else 'null' end",
                              overnemer=_ACQUIRER)),
    _reply("koopsom", _json(koopsom=f"concat({_K}, '.25')", toelichting="'\"plus earn-out\"'")),
    _reply("domeinnamen", _json(
        domeinnamen=f"case when k % 4 = 0 then '[]' else concat('[\"a', {_K}, '.nl\", \"b.nl\"]') end",
        ie_rechten="""case k % 5 when 0 then '"Octrooi op pomp"' when 1 then '"merkrechten en octrooi"'
          when 2 then '"software"' when 3 then 'null' else '"patent"' end""")),
    _reply("directie", _json(
        personen=f"concat('[\" ', {NAME}, ' \", \"', {NAME}, "
                 "'\", \"een natuurlijk persoon\", \"Bo\", null]')",
        bedrijven=_COMPANIES)),
    _reply("bank", _json(banken=_BANKS)),
    _reply("rechtmatigheid", _json(
        boekhoudplicht_voldaan="case k % 3 when 0 then 'true' when 1 then 'false' else 'null' end",
        depot_jaarrekeningen_ok="'\"true\"'", onbehoorlijk_bestuur="'1'",
        paulianeus_handelen="case when k % 2 = 0 then 'false' else '[]' end")),
    _reply("vastgoed", _json(onroerend_goed="case when k % 4 = 0 then 'true' else 'false' end",
                             huurpand="'\"nee\"'")),
    _reply("afwikkeling", _json(
        afwikkeling="case k % 3 when 0 then '\"uitdeling\"' when 1 then '\"anders\"' else '\"akkoord\"' end",
        aantal_concurrente_crediteuren="case k % 4 when 0 then '12' when 1 then '100000' "
                                       "when 2 then '\"7\"' else '3.5' end")),
]

def replies(s: Source) -> DataFrame:
    # keys are dealt out first: a small file of keys is one task, its answers are not small
    parts = int(s.spark.conf.get("spark.sql.shuffle.partitions"))
    keys = s.table("customer").select(F.col("c_custkey").alias("k")).repartition(parts, "k")
    rows = keys.selectExpr(f"concat('K', {_K}) as kenmerk", f"explode(array({', '.join(_ANSWERS)})) as r")
    return rows.select("kenmerk", "r.field", "r.reply")


def worklist(s: Source) -> DataFrame:
    """Every customer with its three reports; for k % 12 = 7 one narrative plays both parts."""
    return s.sql(f"""select concat('K', {_K}) as kenmerk,
        concat(case when k % 12 = 7 then 'late_' else 'early_' end, {_K}) as first_nar,
        concat('late_', {_K}) as last_nar, concat('financial_', {_K}) as last_fin,
        concat('F.01/', {_K}) as insolventienummer, lpad({_K}, 8, '0') as kvk_nummer,
        case when k % 9 = 5 then concat('HOLDING ', {_K}, ' B.V.') else 'Ander bedrijf' end
          as debtor_name from (select c_custkey as k from {{customer}}) c""")


def records(s: Source) -> DataFrame:
    return extract_company(worklist(s), report_texts(s), replies(s), salt=SALT)


# what the oracle knows per case: whether the answer reads, and which sections exist
_CASE = f"""select *, concat('K', cast(k as varchar)) as kenmerk, k % 13 < 11 as a,
    k % 10 = 0 as bare, k % 12 = 7 as single,
    cast(k as varchar) as ks from ({FIG}) f"""

def _if(value: str, cond: str = "a") -> str:
    return f"case when {cond} then {value} end"


# ------------------------------------------------------------------------ requests

_HAS = {
    "sector": "not (bare and single) and not (single and k % 3 <> 0)",
    "oorzaak": "not bare", "doorstart": "not bare", "domeinnamen": "not bare",
    "bank": "not bare", "rechtmatigheid": "not bare", "afwikkeling": "not bare",
    "directie": "true", "vastgoed": "true",
    "koopsom": "a and not bare and k % 3 = 0",
}


def _cases_with_text(s: Source) -> DataFrame:
    from estatelens.plans.extraction import case_sections
    return case_sections(worklist(s), report_texts(s))


@query("prompt_requests", " union all ".join(
    f"select kenmerk, '{f}' as field from ({_CASE}) where {cond}" for f, cond in _HAS.items()))
def _(s: Source) -> DataFrame:
    parsed = responses.answers(replies(s))
    restarts = parsed.filter(responses.restarted(F.col("a_doorstart"))).select("kenmerk")
    return responses.prompt_requests(_cases_with_text(s), restarts=restarts).select("kenmerk", "field")


@query("prompt_texts", f"""select kenmerk, 'oorzaak' as field, concat('1.5 Oorzaak  faillissement',
      chr(10), 'Markt ', ks) as text from ({_CASE}) where not bare
    union all select kenmerk, 'rechtmatigheid', concat('7. Rechtmatigheid', chr(10), 'Geen conclusie ', ks)
      from ({_CASE}) where not bare
    union all select kenmerk, 'doorstart', concat('6. Voortzetten / doorstart onderneming', chr(10),
      'Verkocht aan  Koper', ks, ' B.V. voor') from ({_CASE}) where not bare""")
def _(s: Source) -> DataFrame:
    asked = responses.prompt_requests(_cases_with_text(s))
    return asked.filter(F.col("field").isin("oorzaak", "rechtmatigheid", "doorstart")).select(
        "kenmerk", "field", "text")


# ------------------------------------------------------------------------ validators

def _answered(s: Source) -> DataFrame:
    keyed = s.sql("select c_custkey as k, concat('K', cast(c_custkey as string)) as kenmerk from {customer}")
    return keyed.join(responses.answers(replies(s)), "kenmerk")


@query("valid_sector_cause", f"""select k, {_if("concat('Handel door [persoon] en Voornaam ', ks)")} as activity,
      {_if(D.pick(SECTORS, 'k % 14'))} as sector,
      {_if("concat('Verlies volgens VOORNAAM ', ks)")} as cause, {_if("'markt'")} as label
    from ({_CASE})""")
def _(s: Source) -> DataFrame:
    activity, sector = responses.valid_summary(F.col("a_sector"), "activiteiten", "sector")
    cause, label = responses.valid_summary(F.col("a_oorzaak"), "oorzaak", "categorie")
    return _answered(s).select("k", activity.alias("activity"), sector.alias("sector"),
                               cause.alias("cause"), label.alias("label"))


_ACQUIRER_NAME = """case k % 6 when 1 then concat('koper', ks, ' b.v.') when 4 then concat('Elders ', ks, ' BV')
      when 5 then concat('Koper', ks, ' B.V.') end"""


@query("valid_acquirer", f"""select k, {_if(_ACQUIRER_NAME)} as name,
      coalesce({_if('k % 6 in (1, 5)')}, false) as related,
      case when a and k % 3 < 2 then k % 3 = 0 end as restarted from ({_CASE})""")
def _(s: Source) -> DataFrame:
    text = F.concat(F.lit("Verkocht aan  Koper"), "k", F.lit(" \n B.V. voor"))
    rows = _answered(s).withColumn("name", responses.valid_acquirer(F.col("a_doorstart")))
    return rows.select("k", "name",
                       (F.size(responses.acquirer_relation(F.col("name"), text)) > 0).alias("related"),
                       responses.restarted(F.col("a_doorstart")).alias("restarted"))


_IP = """case k % 5 when 1 then 'merkrechten en octrooi' when 2 then 'software' end"""


@query("valid_domains_ip", f"""select k, case when not a or k % 4 = 0 then ''
      else concat('a', ks, '.nl|b.nl') end as domains, {_if(_IP)} as ip from ({_CASE})""")
def _(s: Source) -> DataFrame:
    text = F.concat(F.lit("3.8 Andere activa\nMerknaam en domein "), "k")
    return _answered(s).select(
        "k", F.array_join(responses.valid_domains(F.col("a_domeinnamen")), "|").alias("domains"),
        responses.valid_ip(F.col("a_domeinnamen"), text).alias("ip"))


def _hash(value: str) -> str:
    return f"substr(sha256(concat('{SALT}', lower({value}))), 1, 12)"


@query("valid_directors", f"""select k, case when a then {_hash("concat('Voornaam ', ks)")} else '' end as hashes,
      case when a then concat('moeder:HOLDING  ', ks, ' b.v.|moeder:Holding ', ks, ' B.V') else '' end
        as companies from ({_CASE})""")
def _(s: Source) -> DataFrame:
    text = F.concat(F.lit("1. Inventarisatie\nBestuurder is Holding "), "k", F.lit(" B.V."))
    people = responses.known_persons(F.col("a_directie"))
    companies = F.transform(responses.director_relations(F.col("a_directie"), text), _shown)
    return _answered(s).select(
        "k", F.array_join(responses.director_hashes(people, SALT), "|").alias("hashes"),
        F.array_join(companies, "|").alias("companies"))


def _shown(r: Column) -> Column:
    return F.concat_ws(":", r["relatie"], r["company_name"])


@query("valid_banks", f"""select k, case when a then concat('Rabobank=vordering ',
      cast(k + k % 2 as varchar), '|Lening ', ks, ' B.V.=') else '' end as banks from ({_CASE})""")
def _(s: Source) -> DataFrame:
    text = F.concat(F.lit("5. Bank / Zekerheden\nDe Rabobank en Lening "), "k", F.lit(" B.V. hebben"))
    banks = F.transform(responses.bank_relations(F.col("a_bank"), text),
                        lambda r: F.concat(r["company_name"], F.lit("="), r["detail"]))
    return _answered(s).select("k", F.array_join(banks, "|").alias("banks"))


_FLAGS = f"""case when a and k % 3 < 2 then k % 3 = 0 end as boekhoudplicht_voldaan,
      cast(null as boolean) as depot_jaarrekeningen_ok, cast(null as boolean) as onbehoorlijk_bestuur,
      case when a and k % 2 = 0 then false end as paulianeus_handelen,
      {_if('k % 4 = 0')} as onroerend_goed, cast(null as boolean) as huurpand"""


@query("valid_flags", f"select k, {_FLAGS} from ({_CASE})")
def _(s: Source) -> DataFrame:
    from estatelens.vocab import GOVERNANCE_FLAGS, PREMISES_FLAGS
    return _answered(s).select(
        "k", *[responses.valid_flag(F.col("a_rechtmatigheid"), f).alias(f) for f in GOVERNANCE_FLAGS],
        *[responses.valid_flag(F.col("a_vastgoed"), f).alias(f) for f in PREMISES_FLAGS])


_SETTLED = "case when not a then '' when k % 3 = 0 then 'uitdeling' when k % 3 = 1 then '' else 'akkoord' end"


@query("valid_settlement", f"""select k, {_SETTLED} as label, case when a and k % 4 = 0 then 12 end
    as creditors from ({_CASE})""")
def _(s: Source) -> DataFrame:
    return _answered(s).select(
        "k", responses.valid_settlement(F.col("a_afwikkeling")).alias("label"),
        responses.valid_creditor_count(F.col("a_afwikkeling")).alias("creditors"))


@query("dedupe_relations", """select c_custkey as k, case when c_custkey % 2 = 0
      then concat('bank:Roos ', cast(c_custkey as varchar), ' BV|moeder:Roos ', cast(c_custkey as varchar), ' BV')
      else 'bank:Iris|moeder:' end as kept from {customer}""")
def _(s: Source) -> DataFrame:
    """Repeats by comparable name go; the debtor goes by containment either way; an empty
    comparable name is nobody's."""

    def rel(kind: str, name: Column) -> Column:
        return F.struct(F.lit(kind).alias("relatie"), name.alias("company_name"), F.lit("").alias("detail"))

    name = F.concat(F.lit("Roos "), "c_custkey", F.lit(" BV"))
    spaced = F.concat(F.lit("ROOS "), "c_custkey", F.lit(" B.V."))
    even = F.array(rel("bank", name), rel("moeder", name), rel("bank", spaced), rel("dochter", F.lit("Tulp Beheer")),
                   rel("dochter", F.lit("Tulp")))
    odd = F.array(rel("bank", F.lit("Iris")), rel("moeder", F.lit("")), rel("dochter", F.lit("tulp-beheer b.v.")),
                  rel("bank", F.lit("IRIS.")))
    chosen = F.when(F.col("c_custkey") % 2 == 0, even).otherwise(odd)
    kept = responses.dedupe_relations(chosen, F.lit("Tulp Beheer B.V."))
    shown = F.array_join(F.transform(kept, lambda r: F.concat(
        r["relatie"], F.lit(":"), r["company_name"])), "|")
    return s.table("customer").select(F.col("c_custkey").alias("k"), shown.alias("kept"))


# ------------------------------------------------------------------------ the whole record
#
# A case with one narrative has no early report: its late one plays both parts.

_RELATIONS = f"""
    select kenmerk, 'overnemer' as relatie, {_ACQUIRER_NAME} as company_name, '' as detail, k, ks, debtor
      from ({_CASE.replace('select *,', "select *, case when k % 9 = 5 then 'own' else '' end as debtor,")})
      where a and not bare and k % 6 in (1, 5)
    union all select kenmerk, 'bank', 'Rabobank', concat('vordering ', cast(k + k % 2 as varchar)), k, ks, ''
      from ({_CASE}) where a and not bare
    union all select kenmerk, 'bank', concat('Lening ', ks, ' B.V.'), '', k, ks, '' from ({_CASE}) where a and not bare
    union all select kenmerk, 'moeder', concat('HOLDING  ', ks, ' b.v.'), '', k, ks, '' from ({_CASE})
      where a and single and not bare and k % 9 <> 5"""


@query("fanout_relations", f"select kenmerk, relatie, company_name, detail from ({_RELATIONS})")
def _(s: Source) -> DataFrame:
    return fanout.to_relations(records(s))


_MERGED_CASES = f"""select concat('K', cast(k as varchar)) as kenmerk, jaar, omzet, winst_verlies, balanstotaal
    from ({MERGED}) where k % 12 <> 7
    union all select concat('K', cast(m.k as varchar)), m.jaar, m.omzet, m.winst_verlies, m.balanstotaal
    from ({{late}}) m where k % 12 = 7"""


def _merged_cases() -> str:
    from checks.reports import _late_rows
    return _MERGED_CASES.replace("{late}", _late_rows())


@query("fanout_revenue", _merged_cases())
def _(s: Source) -> DataFrame:
    return fanout.to_revenue(records(s))


@query("fanout_asset_sales", f"""select concat('K', cast(k as varchar)) as kenmerk, categorie,
      bedrag as verkoopopbrengst from ({ASSETS})""")
def _(s: Source) -> DataFrame:
    return fanout.to_asset_sales(records(s))


_COUNT = """coalesce(concurrent_aantal, case when k % 13 < 11 and k % 4 = 0 then 12 end)"""


@query("fanout_debt", f"""select concat('K', cast(k as varchar)) as kenmerk, boedelvorderingen, pref_fiscus, pref_uwv,
      pref_overig, pref_totaal, concurrent_bedrag, {_COUNT} as concurrent_aantal from ({DEBT})""")
def _(s: Source) -> DataFrame:
    return fanout.to_debt(records(s))


PROFILE = f"""select kenmerk, concat('F.01/', ks) as insolventienummer, lpad(ks, 8, '0') as kvk_nummer,
      coalesce({_if(D.pick(SECTORS, 'k % 14'))}, '') as sector,
      coalesce({_if("'Handel door [persoon] en [persoon]'")}, '') as activiteiten,
      coalesce({_if("'Verlies volgens [persoon]'")}, '') as oorzaak, coalesce({_if("'markt'")}, '') as oorzaak_categorie,
      case when a and k % 3 < 2 then k % 3 = 0 end as doorstart, {_if(_ACQUIRER_NAME)} as overnemer,
      case when not a or k % 4 = 0 then '' else concat('a', ks, '.nl|b.nl') end as domeinnamen,
      case when bare then {_if("case k % 5 when 2 then 'software' end")} else {_if(_IP)} end as ie_rechten,
      case when a and k % 3 = 0 then k + 0.25::double end as koopsom,
      case when a and k % 3 = 0 then 'plus earn-out' end as koopsom_toelichting,
      case when a then {_hash("concat('Voornaam ', ks)")} else '' end as bestuurders_gehasht,
      {_FLAGS}, {_SETTLED} as afwikkeling,
      cast(bal as double) as definitief_saldo, cast(bal + 1 as double) as saldo_boedelrekening,
      case when k % 4 = 0 then cast(a5 as double) end as beschikbaar_voor_uitdeling,
      case when k % 9 <> 0 then cast(cast(k % 100 + (k % 7) / 100.0 as decimal(10, 2)) as double) end
        as pref_recovery_pct, 0.0::double as conc_recovery_pct,
      case when bare or k % 6 in (2, 3) then
          case when single then case when bare or k % 6 = 3 then null else n end end
        when k % 6 = 5 then null else n end as personeel_ttv,
      case when bare or k % 6 in (2, 3) then
          case when single then case when bare or k % 6 = 3 then null else n + 1 end else n + 5 end
        else n + 1 end as personeel_jaar_voor, 'geen' as model from ({_CASE})"""


def _shown_profile(found: DataFrame, *extra: str) -> DataFrame:
    lists = {c: F.array_join(c, "|") for c in ("domeinnamen", "bestuurders_gehasht")}
    counts = {c: F.col(c).cast("bigint") for c in ("personeel_ttv", "personeel_jaar_voor")}
    return fanout.to_profile(found, "geen", extra).withColumns({**lists, **counts})


@query("fanout_profile", PROFILE)
def _(s: Source) -> DataFrame:
    return _shown_profile(records(s))


EXTRACTED = f"""select p.*, coalesce(n_years, 0) as n_years, coalesce(n_assets, 0) as n_assets,
      coalesce(n_relations, 0) as n_relations, uwv from ({PROFILE}) p
    left join (select kenmerk, count(*) as n_years from ({_merged_cases()}) group by 1) y on p.kenmerk = y.kenmerk
    left join (select concat('K', cast(k as varchar)) as kenmerk, count(*) as n_assets from ({ASSETS}) group by 1) s
      on p.kenmerk = s.kenmerk
    left join (select kenmerk, count(*) as n_relations from ({_RELATIONS}) group by 1) r on p.kenmerk = r.kenmerk
    left join (select concat('K', cast(k as varchar)) as kenmerk, pref_uwv as uwv from ({DEBT})) d
      on p.kenmerk = d.kenmerk"""


def _sized_profile(found: DataFrame) -> DataFrame:
    sized = found.withColumns({
        "n_years": F.size("omzet_historie").cast("bigint"),
        "n_assets": F.size("asset_realizations").cast("bigint"),
        "n_relations": F.size("relations").cast("bigint"), "uwv": F.col("debt.pref_uwv")})
    return _shown_profile(sized, "n_years", "n_assets", "n_relations", "uwv")


@query("extract_company", EXTRACTED)
def _(s: Source) -> DataFrame:
    """Flagship: one record per case, shown as its profile with the sizes of its parts."""
    return _sized_profile(records(s))


def _mined_twice(s: Source) -> tuple[DataFrame, DataFrame]:
    """The mined-report table after two runs, and the texts that count.

    The first run meets the reports of even customers, some with an older text; the second all.
    """
    folder = work_dir(s.spark, "mined")
    report_texts(s).write.parquet(f"{folder}/texts")
    texts = s.spark.read.parquet(f"{folder}/texts")
    older = F.when((F.col("k") % 10 == 0) & (F.col("role") == "late"),
                   F.concat("text", F.lit("\n2. Personeel\nAantal ten tijde van faillissement\n 4")))
    first = texts.filter("k % 2 = 0").withColumn("text", F.coalesce(older, "text"))
    add_reports(first, f"{folder}/mined", datetime(2026, 1, 1))
    add_reports(texts, f"{folder}/mined", datetime(2026, 1, 2))
    return mined_reports(s.spark, f"{folder}/mined"), texts


@query("extract_mined", EXTRACTED)
def _(s: Source) -> DataFrame:
    """Records from reports mined in two runs: those of one run over all texts."""
    mined, texts = _mined_twice(s)
    return _sized_profile(extract_mined(worklist(s), mined, report_keys(texts), replies(s),
                                        salt=SALT))


@query("mined_rounds", """select '2026-01-01' as first_mined, 3 * count(*) as n from {customer}
      where c_custkey % 2 = 0
    union all select '2026-01-02', 3 * count(*) filter (where c_custkey % 2 = 1)
      + count(*) filter (where c_custkey % 10 = 0) from {customer}""")
def _(s: Source) -> DataFrame:
    """A report is mined when its text is first met: a changed text is a new one."""
    mined, _ = _mined_twice(s)
    firsts = mined.groupBy("document_kenmerk", "text_digest").agg(F.min("mined_at").alias("at"))
    return firsts.groupBy(F.date_format("at", "yyyy-MM-dd").alias("first_mined")).agg(
        F.count(F.lit(1)).alias("n"))


@query("live_extraction", f"""select 'processed_revenue' as table_name, kenmerk,
      cast(jaar as varchar) as item, omzet as amount from ({_merged_cases()}) y
    union all select 'processed_asset_sales', concat('K', cast(k as varchar)), categorie, bedrag
      from ({ASSETS}) a
    union all select 'processed_debt', concat('K', cast(k as varchar)), 'uwv', pref_uwv from ({DEBT}) d
    union all select 'processed_relations', kenmerk, concat(relatie, ' ', company_name), null
      from ({_RELATIONS}) r
    union all select 'processed_profile', kenmerk, sector, koopsom from ({PROFILE}) p""")
def _(s: Source) -> DataFrame:
    """Two extractions of the same cases into five tables: the live rows are those of one."""
    folder = work_dir(s.spark, "extraction")
    found = records(s)
    for day in (1, 2):
        fanout.write_extraction(found, folder, datetime(2026, 1, day))
    live = {name: live_rows(s.spark, f"{folder}/{name}", spec)
            for name, spec in fanout.EXTRACTED.items()}
    shown = {"processed_revenue": (F.col("jaar").cast("string"), F.col("omzet")),
             "processed_asset_sales": (F.col("categorie"), F.col("verkoopopbrengst")),
             "processed_debt": (F.lit("uwv"), F.col("pref_uwv")),
             "processed_relations": (F.concat_ws(" ", "relatie", "company_name"),
                                     F.lit(None).cast("double")),
             "processed_profile": (F.col("sector"), F.col("koopsom"))}
    parts = [live[name].filter(F.col("extracted_at") == F.lit(datetime(2026, 1, 2))).select(
        F.lit(name).alias("table_name"), "kenmerk", item.alias("item"), amount.alias("amount"))
        for name, (item, amount) in shown.items()]
    return reduce(DataFrame.unionByName, parts)

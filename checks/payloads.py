"""Nested payloads rendered from table columns: search results, cases, reports, listing pages,
probe replies, and the attempt log's JSON records."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.base import (
    D, ENTITY, S, Source, court, listing, query, raw,
)
from estatelens.operators import fanout
from estatelens.session import work_dir
from estatelens.sources import listing as pages
from estatelens.sources import payloads, rawlog
from estatelens.streaming.jobs import OUTPUTS, write_fanout

SALT = "zout"


def _obj(*pairs) -> Column:
    """JSON object from name/value pairs; NULL values are left out."""
    return F.to_json(F.struct(*[v.alias(n) for n, v in pairs]))


def _wrap(head: str, body: Column, tail: str) -> Column:
    return F.concat(F.lit(head), body, F.lit(tail))


# ------------------------------------------------------------------------------- raw log

SINCE = datetime(1995, 6, 1)


@query("scan_raw_ok", f"""select kenmerk, cast(scraped_at as varchar) as scraped_at, record from (
    select kenmerk, scraped_at, concat('r', cast(o_orderkey as varchar)) as record
    from ({raw(D)}) r where status = 'ok' and o_custkey % 9 <> 0
      and scraped_at > timestamp '1995-06-01 00:00:00'
)""")
def _(s: Source) -> DataFrame:
    log = s.sql(f"""select kenmerk, scraped_at, status, case when o_custkey % 9 = 0 then ''
        else concat('r', cast(o_orderkey as string)) end as record from ({raw(S)}) r""")
    out = rawlog.raw_ok(log, SINCE)
    return out.withColumn("scraped_at", F.col("scraped_at").cast("string"))


_AFTER = ("1997-03-05 00:00:00", "K3000")


@query("incremental_batch", f"""select kenmerk, cast(scraped_at as varchar) as scraped_at from (
    select kenmerk, scraped_at from (select kenmerk, cast(date_trunc('day', scraped_at) as timestamp)
      as scraped_at from ({raw(D)}) r where status = 'ok')
    where scraped_at > timestamp '{_AFTER[0]}'
      or (scraped_at = timestamp '{_AFTER[0]}' and kenmerk > '{_AFTER[1]}'))""")
def _(s: Source) -> DataFrame:
    """Many rows share a timestamp here: the id part of the checkpoint decides among them."""
    out = rawlog.incremental_batch(_daily(s), (datetime.fromisoformat(_AFTER[0]), _AFTER[1]))
    return out.select("kenmerk", F.col("scraped_at").cast("string").alias("scraped_at"))


def _daily(s: Source) -> DataFrame:
    return s.sql(f"""select kenmerk, cast(cast(scraped_at as date) as timestamp_ntz) as scraped_at,
        status, 'r' as record from ({raw(S)}) r""")


@query("oldest_batch", f"""select kenmerk, cast(scraped_at as varchar) as scraped_at from (
    select kenmerk, scraped_at from (select kenmerk, cast(date_trunc('day', scraped_at) as timestamp)
      as scraped_at from ({raw(D)}) r where status = 'ok')
    where scraped_at > timestamp '{_AFTER[0]}'
      or (scraped_at = timestamp '{_AFTER[0]}' and kenmerk > '{_AFTER[1]}')
    order by scraped_at, kenmerk limit 300)""")
def _(s: Source) -> DataFrame:
    """A batch of the oldest attempts, fewer than there are."""
    out = rawlog.incremental_batch(_daily(s), (datetime.fromisoformat(_AFTER[0]), _AFTER[1]), 300)
    return out.select("kenmerk", F.col("scraped_at").cast("string").alias("scraped_at"))


_DAYS = f"""select kenmerk, cast(date_trunc('day', scraped_at) as timestamp) as scraped_at
    from ({raw(D)}) r where status = 'ok'"""


@query("take_batch", f"""with log as ({_DAYS}),
    first as (select kenmerk, scraped_at from log where not kenmerk like '%3'
        and scraped_at > timestamp '{_AFTER[0]}' order by scraped_at, kenmerk limit 300),
    top as (select scraped_at, kenmerk from first order by 1 desc, 2 desc limit 1)
    select 0 as step, kenmerk, cast(scraped_at as varchar) as scraped_at from first union all
    select 1, log.kenmerk, cast(log.scraped_at as varchar) from log, top
    where log.scraped_at > top.scraped_at
      or (log.scraped_at = top.scraped_at and log.kenmerk > top.kenmerk)""")
def _(s: Source) -> DataFrame:
    """Rows arrive after the first batch is committed: asked for again, it is as it was, and the
    second goes on behind it with all that has come by then."""
    log, folder = _daily(s), work_dir(s.spark, "batches")
    start = (datetime.fromisoformat(_AFTER[0]), "~")
    rawlog.take_batch(log.where("not kenmerk like '%3'"), folder, 0, start, 300)
    steps = [rawlog.take_batch(log, folder, 0, start, 300),
             rawlog.take_batch(log, folder, 1, start)]
    return steps[0].withColumn("step", F.lit(0)).union(steps[1].withColumn("step", F.lit(1))).select(
        "step", "kenmerk", F.col("scraped_at").cast("string").alias("scraped_at"))


@query("next_checkpoint", f"""select kenmerk, cast(scraped_at as varchar) as scraped_at from (
    select kenmerk, scraped_at from ({raw(D)}) r where status = 'ok'
      and scraped_at > timestamp '1995-06-01 00:00:00') order by 2 desc, 1 desc limit 1""")
def _(s: Source) -> DataFrame:
    log = s.sql(f"select kenmerk, scraped_at, status, 'r' as record from ({raw(S)}) r")
    out = rawlog.next_checkpoint(rawlog.incremental_batch(log, (SINCE, "~")))
    return out.select("kenmerk", F.col("scraped_at").cast("string").alias("scraped_at"))


# ------------------------------------------------------------- records in the attempt log

_LINES = """select l_orderkey, count(*) as n_pubs,
    count(*) filter (where l_returnflag <> 'N') as n_docs from {lineitem} group by l_orderkey"""


def records(s: Source) -> DataFrame:
    """Attempt log with records: an order is an attempt, its lines are publications, its returned
    lines are documents.  Some records are malformed, some carry no id of their own."""
    pub = F.struct(
        F.when(F.col("l_partkey") % 10 == 0, F.lit("3026-01-01"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("date"),
        F.concat("l_orderkey", F.lit("."), "l_linenumber", F.lit("."), "l_partkey",
                 F.lit("."), "l_suppkey").alias("kenmerk"),
        F.concat(F.lit("regel "), "l_partkey").alias("description"),
        F.lit("einde").alias("event_type"),
        F.when(F.col("l_suppkey") % 2 == 0, F.lit("verzet")).alias("event_subtype"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("event_date"),
        F.lit("faillissement").alias("insolvency_type"))
    doc = F.when(F.col("l_returnflag") != "N", F.struct(
        pub["kenmerk"].alias("kenmerk"),
        F.when(F.col("l_partkey") % 20 != 0, F.date_format("l_shipdate", "yyyy-MM-dd"))
        .alias("date"), F.lit("Verslag").alias("type")))
    nested = s.table("lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(pub)).alias("pubs"),
        F.array_sort(F.collect_list(doc)).alias("docs"))
    log = s.sql(f"""select r.*, c_name, c_nationkey, {ENTITY} as kind, {court(S)} as court
        from ({raw(S)}) r join {{customer}} on o_custkey = c_custkey""")
    joined = log.join(nested, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    own = F.col("c_nationkey") % 3 == 0
    street = F.struct(*[F.lit(v).alias(k) for k, v in (
        ("type", "woon"), ("street", "Kerkstraat"), ("number", "1"))],
        F.when(F.col("c_nationkey") % 4 != 0, F.concat(F.lit("Woon"), "c_nationkey"))
        .alias("city"))
    office = F.struct(F.lit("vestiging").alias("type"), F.lit("Plein").alias("street"),
                      F.lit("2").alias("number"),
                      F.when(F.col("c_nationkey") % 5 == 0, F.concat(
                          F.lit("Vest"), "c_nationkey")).otherwise(F.lit("")).alias("city"))
    body = F.to_json(F.struct(
        F.when(own, F.concat(F.lit("R"), "o_orderkey")).alias("kenmerk"),
        F.concat(F.lit("F.01/01/"), "o_custkey").alias("insolventienummer"),
        F.col("kind").alias("type"), F.col("court"),
        F.when(F.col("c_nationkey") % 2 == 0, F.lit("mr. Bos")).alias("judge"),
        (F.col("kind") != "company").alias("is_anonymized"),
        F.struct(F.col("c_name").alias("name"),
                 F.when(F.col("kind") == "company", F.lit("01234567")).alias("kvk_nummer"),
                 F.array(street, office).alias("addresses")).alias("debtor"),
        F.array(*[F.struct(F.lit(name).alias("name"), F.lit("06").alias("phone"))
                  for name in ("mr. A", None)]).alias("curators"),
        F.col("pubs").alias("publications"), F.col("docs").alias("documents")))
    record = (F.when(F.col("status") != "ok", "")
              .when(F.col("o_orderkey") % 97 == 0, '{"kenmerk": "half')
              .when(F.col("o_orderkey") % 97 == 1, "geen json").otherwise(body))
    return joined.select("kenmerk", "scraped_at", "status", "entity_type",
                         record.alias("record"), "o_orderkey")


_OK = f"""select r.*, c_name, c_nationkey, {ENTITY} as kind, {court(D)} as court,
      case when c_nationkey % 3 = 0 then concat('R', cast(o_orderkey as varchar)) else kenmerk end
        as own_id
    from ({raw(D)}) r join {{customer}} on o_custkey = c_custkey
    where status = 'ok'"""
_GOOD = f"select * from ({_OK}) where o_orderkey % 97 > 1"


def _good(s: Source) -> DataFrame:
    usable = records(s).filter("status = 'ok' and record != ''")
    return rawlog.decode_record(usable)[0]


@query("decode_record", f"""select kenmerk, o_orderkey, o_orderkey % 97 > 1 as good,
      case when o_orderkey % 97 > 1 and c_nationkey % 3 = 0
        then concat('R', cast(o_orderkey as varchar)) end as own_id,
      case when o_orderkey % 97 > 1 then c_name end as debtor,
      case when o_orderkey % 97 > 1 then n_pubs end as n_pubs
    from ({_OK}) k left join ({_LINES}) n on o_orderkey = l_orderkey""")
def _(s: Source) -> DataFrame:
    good, bad = rawlog.decode_record(records(s).filter("status = 'ok' and record != ''"))
    return good.select(
        "kenmerk", "o_orderkey", F.lit(True).alias("good"), F.col("record.kenmerk").alias("own_id"),
        F.col("record.debtor.name").alias("debtor"),
        F.size("record.publications").cast("bigint").alias("n_pubs")).unionByName(bad.select(
            "kenmerk", "o_orderkey", F.lit(False).alias("good"),
            *[F.lit(None).cast(t).alias(n) for n, t in (
                ("own_id", "string"), ("debtor", "string"), ("n_pubs", "bigint"))]))


CASE_ROWS = f"""select own_id as kenmerk, kenmerk as task_kenmerk,
      concat('F.01/01/', cast(o_custkey as varchar)) as insolventienummer,
      '' as toezichtzaaknummer, kind as type, court,
      case when c_nationkey % 2 = 0 then 'mr. Bos' else '' end as judge,
      kind <> 'company' as is_anonymized, c_name as debtor_name,
      case when kind = 'company' then '01234567' end as kvk_nummer,
      case when c_nationkey % 5 = 0 then concat('Vest', cast(c_nationkey as varchar))
           when c_nationkey % 4 <> 0 then concat('Woon', cast(c_nationkey as varchar)) end as city,
      'mr. A|' as curator_names, coalesce(n_pubs, 0) as publication_count,
      coalesce(n_docs, 0) as document_count, cast(scraped_at as varchar) as scraped_at
    from ({_GOOD}) k left join ({_LINES}) n on o_orderkey = l_orderkey"""


@query("fanout_cases", CASE_ROWS)
def _(s: Source) -> DataFrame:
    out = fanout.to_cases(_good(s))
    return out.withColumns({
        "curator_names": F.array_join("curator_names", "|"),
        "scraped_at": F.col("scraped_at").cast("string"),
        **{c: F.col(c).cast("bigint") for c in ("publication_count", "document_count")}})


_CITIES = f"""select o_orderkey, case when c_nationkey % 5 = 0
      then concat('Vest', cast(c_nationkey as varchar))
      when c_nationkey % 4 <> 0 then concat('Woon', cast(c_nationkey as varchar)) end as city
    from ({_GOOD}) k"""


@query("pick_city", _CITIES)
def _(s: Source) -> DataFrame:
    return _good(s).select("o_orderkey", fanout.pick_city(F.col("record.debtor.addresses"))
                           .alias("city"))


_LINE_ID = ("concat(cast(l_orderkey as varchar), '.', cast(l_linenumber as varchar), '.', "
            "cast(l_partkey as varchar), '.', cast(l_suppkey as varchar))")


PUBLICATION_ROWS = f"""select own_id as kenmerk, {_LINE_ID} as publicatie_kenmerk,
      case when l_partkey % 10 <> 0 then cast(cast(l_shipdate as date) as varchar) end
        as publicatie_datum,
      concat('regel ', cast(l_partkey as varchar)) as description, 'einde' as event_type,
      case when l_suppkey % 2 = 0 then 'verzet' end as event_subtype,
      cast(cast(l_shipdate as date) as varchar) as event_date,
      'faillissement' as insolvency_type, cast(scraped_at as varchar) as scraped_at
    from ({_GOOD}) k join {{lineitem}} on o_orderkey = l_orderkey"""


@query("fanout_publications", PUBLICATION_ROWS)
def _(s: Source) -> DataFrame:
    out = fanout.to_publications(_good(s)).drop("task_kenmerk")
    return out.withColumns({c: F.col(c).cast("string") for c in (
        "publicatie_datum", "event_date", "scraped_at")})


DOCUMENT_ROWS = f"""select own_id as kenmerk, {_LINE_ID} as document_kenmerk,
      case when l_partkey % 20 <> 0 then cast(cast(l_shipdate as date) as varchar) end
        as document_date, 'Verslag' as document_type, cast(null as varchar) as pdf_path,
      cast(scraped_at as varchar) as scraped_at
    from ({_GOOD}) k join {{lineitem}} on o_orderkey = l_orderkey where l_returnflag <> 'N'"""


@query("fanout_documents", DOCUMENT_ROWS)
def _(s: Source) -> DataFrame:
    out = fanout.to_documents(_good(s)).drop("task_kenmerk")
    return out.withColumns({c: F.col(c).cast("string") for c in ("document_date", "scraped_at")})


_DETAIL = {
    "processed_cases": ("task_kenmerk", (
        "insolventienummer", "toezichtzaaknummer", "type", "court", "judge", "is_anonymized",
        "debtor_name", "kvk_nummer", "city", "curator_names", "publication_count",
        "document_count")),
    "processed_publications": ("publicatie_kenmerk", (
        "publicatie_datum", "description", "event_type", "event_subtype", "event_date",
        "insolvency_type")),
    "processed_documents": ("document_kenmerk", ("document_date", "document_type", "pdf_path")),
}

FANOUT_ROWS = " union all ".join(
    f"""select '{name}' as table_name, kenmerk, {_DETAIL[name][0]} as item,
      concat_ws('~', {", ".join(f"cast({c} as varchar)" for c in _DETAIL[name][1])}) as detail,
      scraped_at, substr(scraped_at, 1, 7) as scraped_month from ({rows}) t{i}"""
    for i, (name, rows) in enumerate(zip(
        _DETAIL, (CASE_ROWS, PUBLICATION_ROWS, DOCUMENT_ROWS))))
BAD_ROWS = f"""select kenmerk, cast(scraped_at as varchar) as scraped_at,
    case when o_orderkey % 97 = 0 then '{{{{"kenmerk": "half' else 'geen json' end as record
  from ({_OK}) b where o_orderkey % 97 <= 1"""


def fanout_content(tables: dict[str, DataFrame]) -> DataFrame:
    """Every row of the three output tables, in the columns of ``FANOUT_ROWS``."""
    parts = []
    for name, rows in tables.items():
        item, columns = _DETAIL[name]
        if "curator_names" in columns:
            rows = rows.withColumn("curator_names", F.array_join("curator_names", "|"))
        parts.append(rows.select(
            F.lit(name).alias("table_name"), "kenmerk", F.col(item).alias("item"),
            F.concat_ws("~", *[F.col(c).cast("string") for c in columns]).alias("detail"),
            F.col("scraped_at").cast("string").alias("scraped_at"),
            F.col("scraped_month").cast("string").alias("scraped_month")))
    return parts[0].union(parts[1]).union(parts[2])


@query("sink_fanout", FANOUT_ROWS)
def _(s: Source) -> DataFrame:
    """Writes one batch twice, as a replay would: the tables must not change."""
    out, log = work_dir(s.spark, "fanout"), work_dir(s.spark, "fanout-log")
    rendered = records(s)
    rendered.write.parquet(log)
    for _ in range(2):
        batch = s.spark.read.schema(rendered.schema).parquet(log)
        write_fanout(batch, out, run_id="a", batch_id=7)
    return fanout_content({name: s.spark.read.parquet(f"{out}/{name}") for name in OUTPUTS})


# --------------------------------------------------------------------------------- search


def _search(d, string: str) -> str:
    page = d.div("event_id", 20)
    return (f"select event_id, {page} as page, {court(d, page)} as court, event_type, "
            f"concat('E', cast(event_id as {string})) as kenmerk from {{events}}")


@query("decode_search", f"""select court, event_id % 20 as position, kenmerk,
      case when event_id % 3 = 1 then '' else event_type end as description
    from ({_search(D, 'varchar')}) e where event_type <> 'error' and page % 7 <> 6""")
def _(s: Source) -> DataFrame:
    """Twenty events per reply, in six envelopes; one page in seven is cut off."""
    rows = s.sql(_search(S, "string"))
    third = F.col("event_id") % 3
    ident = F.when(F.col("event_type") != "error", F.col("kenmerk")).otherwise("")
    item = F.struct(
        F.when(third == 0, ident).when(third == 2, "").alias("publicatiekenmerk"),
        F.when(third == 1, ident).alias("publicatieKenmerk"),
        F.when(third == 2, ident).alias("kenmerk"),
        F.when(third == 0, F.col("event_type")).alias("publicatieomschrijving"),
        F.when(third == 2, F.col("event_type")).alias("omschrijving"))
    grouped = rows.groupBy("page", "court").agg(F.to_json(F.transform(
        F.array_sort(F.collect_list(F.struct("event_id", item.alias("item")))),
        lambda e: e["item"])).alias("items"))
    items, kind = F.col("items"), F.col("page") % 7
    body = (F.when(kind == 0, _wrap('{"result": {"model": {"items": ', items, "}, \"status\": 1}}"))
            .when(kind == 1, _wrap('{"result": ', items, "}"))
            .when(kind == 2, items)
            .when(kind == 3, _wrap('{"result": {"items": ', items, "}}"))
            .when(kind == 4, _wrap('{"model": {"items": ', items, "}}"))
            .when(kind == 5, _wrap('{"result": {"model": ', items, "}}"))
            .otherwise(_wrap('{"result": ', items, "")))
    out = payloads.decode_search(grouped.select("court", body.alias("body")))
    return out.withColumn("position", F.col("position").cast("bigint"))


# ---------------------------------------------------------------------------------- cases

_ORDERS_OF = "select o_custkey, count(*) as n, min(o_orderkey) as first_order from {orders} group by 1"


#: Texts that parse as JSON, but for the first, and hold no case that could be read.
UNREADABLE = ["<html>", "null", "[]", '"x"', "5", '{"model": 7}', '{"model": {"persoon": [1]}}',
              '{"model": {"curators": {"a": 1}}}', '{"model": {"publicatiegeschiedenis": ["x"]}}']


def payload_rows(s: Source) -> DataFrame:
    """One case payload per customer: its orders are the publication history.

    Segments set who the debtor is; keys modulo small numbers drop or add single fields.
    """
    pub = F.struct(
        F.col("o_orderkey").alias("k"),
        F.concat(F.lit("/Date("), F.unix_millis(F.col("o_orderdate").cast("timestamp")),
                 F.lit("+0100)/")).alias("publicatieDatum"),
        F.concat(F.lit("P"), "o_orderkey").alias("publicatieKenmerk"),
        F.concat(F.lit("Einde faillissement op "), F.dayofmonth("o_orderdate"), F.lit(" mei "),
                 F.year("o_orderdate")).alias("publicatieOmschrijving"))
    history = s.table("orders").groupBy("o_custkey").agg(
        F.array_sort(F.collect_list(pub)).alias("h"))
    k = F.col("c_custkey")
    segment = F.col("c_mktsegment")

    def when(cond, value) -> Column:
        return F.when(cond, value if isinstance(value, Column) else F.lit(value))

    def address(kind: str) -> Column:
        return F.array(F.struct(
            F.lit(f"{kind}straat").alias("straat"), k.cast("string").alias("huisnummer"),
            when(k % 2 == 0, "A").alias("huisnummerToevoeging1"),
            when(k % 3 == 0, "bis").alias("huisnummerToevoeging2"),
            F.lit("1234 AB").alias("postcode"), F.concat(F.lit(kind), k).alias("plaats")))

    person = F.struct(
        when(segment == "BUILDING", "11111111").alias("KvKNummer"),
        when(segment == "MACHINERY", "22222222").alias("kvkNummer"),
        when(segment.isin("AUTOMOBILE", "FURNITURE"), "Jan").alias("voornaam"),
        when(segment == "AUTOMOBILE", "van").alias("voorvoegsel"),
        F.col("c_name").alias("achternaam"))
    trade_object = F.struct(
        F.concat(F.lit("Zaak "), k).alias("handelsnaam"),
        when(k % 2 == 1, "33333333").alias("KvKNummer"),
        when(k % 5 == 0, address("handel")).alias("vestigingsadressen"))
    trade = F.when(k % 3 == 0, F.concat(
        F.lit('["Los BV",'), F.to_json(trade_object), F.lit(',"Klaver"]')))

    def trustee(surname: str, with_address: Column) -> Column:
        return F.array(F.struct(
            F.lit("mr.").alias("titulatuur"), F.lit("A.").alias("voorletters"),
            when(k % 2 == 0, "de").alias("voorvoegsel"), F.lit(surname).alias("achternaam"),
            F.when(with_address, F.struct(
                when(k % 4 != 0, "Plein").alias("straat"), F.lit("7").alias("huisnummer"),
                when(k % 5 != 0, "9999 ZZ").alias("postcode"),
                when(k % 7 != 0, "Assen").alias("plaats"),
                F.lit("06").alias("telefoonnummer"))).alias("adres")))

    fixed = F.to_json(F.struct(
        person.alias("persoon"),
        when(k % 2 == 0, address("vest")).alias("vestigingsadressen"),
        when(k % 5 != 1, address("woon")).alias("woonadressen"),
        trustee("Bos", k % 3 != 0).alias("curators"),
        when(k % 4 == 0, trustee("Vos", F.lit(True))).alias("bewindvoerders"),
        F.transform("h", lambda p: F.struct(*[p[f].alias(f) for f in (
            "publicatieDatum", "publicatieKenmerk", "publicatieOmschrijving")]))
        .alias("publicatiegeschiedenis"),
        when(k % 10 != 0, F.concat(F.lit("F.01/01/"), k)).alias("landelijkUniekZaaknummer"),
        F.lit("Rechtbank Assen").alias("behandelendeInstantieNaam"),
        when(k % 2 == 0, "mr. R").alias("RC")))
    model = F.when(trade.isNull(), fixed).otherwise(F.concat(
        F.lit('{"handelendOnderDeNamen":'), trade, F.lit(","), F.substring(fixed, 2, 1 << 30)))
    body = (F.when(k % 23 == 22, F.lit(None).cast("string"))
            .when(k % 23 == 21, F.element_at(
                F.array(*map(F.lit, UNREADABLE)), (F.floor(k / 23) % len(UNREADABLE) + 1)
                .cast("int")))
            .when(k % 23 == 20, '{"model": null, "status": 0}')
            .when(k % 23 == 19, model)
            .otherwise(_wrap('{"model": ', model, ', "status": 1}')))
    joined = s.table("customer").join(history, k == F.col("o_custkey"), "left")
    return joined.select(k, F.concat(F.lit("Q"), k).alias("query_kenmerk"), body.alias("payload"),
                         F.lit(datetime(2026, 1, 2, 3, 4, 5)).alias("scraped_at"))


def _decoded(s: Source) -> DataFrame:
    return payloads.readable_cases(payload_rows(s)).select("c_custkey", "record")


_TYPE = """case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'company'
      when c_mktsegment in ('AUTOMOBILE', 'FURNITURE')
        then case when c_custkey % 6 = 3 then 'eenmanszaak' else 'person' end
      when c_custkey % 6 = 3 then 'company' else 'person' end"""
_KVK = """case c_mktsegment when 'BUILDING' then '11111111' when 'MACHINERY' then '22222222'
      else case when c_custkey % 6 = 3 then '33333333' end end"""
_NAME = """case c_mktsegment when 'AUTOMOBILE' then concat('Jan van ', c_name)
      when 'FURNITURE' then concat('Jan ', c_name) else c_name end"""
_CASES = f"""select c_custkey, {_TYPE} as type, {_KVK} as kvk_nummer, {_NAME} as name,
      concat('Q', cast(c_custkey as varchar)) as query_id, coalesce(n, 0) as n_orders, first_order
    from {{customer}} left join ({_ORDERS_OF}) o on c_custkey = o_custkey
    where c_custkey % 23 < 20"""


@query("attempt_status", """select c_custkey, case when c_custkey % 23 > 20 then 'fetch_failed'
      when c_custkey % 23 = 20 then 'purged' else 'ok' end as status from {customer}""")
def _(s: Source) -> DataFrame:
    return payload_rows(s).select("c_custkey", payloads.attempt_status(F.col("payload"))
                                  .alias("status"))


@query("payload_status", """select c_custkey, case when c_custkey % 23 > 20 then 'fetch_failed'
      when c_custkey % 23 = 20 then 'purged' else 'ok' end as status,
      c_custkey % 23 < 20 as readable from {customer}""")
def _(s: Source) -> DataFrame:
    """The status that comes with the parse."""
    return payloads.read_payloads(payload_rows(s)).select(
        "c_custkey", "status", F.col("m").isNotNull().alias("readable"))


@query("entity_type", f"select c_custkey, type, kvk_nummer from ({_CASES})")
def _(s: Source) -> DataFrame:
    return _decoded(s).select("c_custkey", "record.type", "record.debtor.kvk_nummer")


@query("debtor_name", f"select c_custkey, name from ({_CASES})")
def _(s: Source) -> DataFrame:
    return _decoded(s).select("c_custkey", "record.debtor.name")


_NUMBER = """concat(cast(c_custkey as varchar), case when c_custkey % 2 = 0 then ' A' else '' end,
      case when c_custkey % 3 = 0 then ' bis' else '' end)"""


@query("house_number", f"""select c_custkey, concat_ws('|',
      case when c_custkey % 2 = 0 then concat('vestiging:', {_NUMBER}, ':vest', cast(c_custkey as varchar)) end,
      case when c_custkey % 5 <> 1 then concat('woon:', {_NUMBER}, ':woon', cast(c_custkey as varchar)) end,
      case when c_custkey % 15 = 0 then concat('vestiging:', {_NUMBER}, ':handel', cast(c_custkey as varchar)) end)
      as addresses from ({_CASES})""")
def _(s: Source) -> DataFrame:
    shown = F.transform("record.debtor.addresses", lambda a: F.concat_ws(
        ":", a["type"], a["number"], a["city"]))
    return _decoded(s).select("c_custkey", F.array_join(shown, "|").alias("addresses"))


_TRUSTEES = """concat('mr. A. ', case when c_custkey % 2 = 0 then 'de ' else '' end, 'Bos',
      case when c_custkey % 4 = 0 then '|mr. A. de Vos' else '' end)"""


@query("trustee_name", f"select c_custkey, {_TRUSTEES} as names from ({_CASES})")
def _(s: Source) -> DataFrame:
    names = F.transform("record.curators", lambda c: c["name"])
    return _decoded(s).select("c_custkey", F.array_join(names, "|").alias("names"))


_PLACE = """nullif(concat_ws(', ', case when c_custkey % 4 <> 0 then 'Plein 7' end,
      nullif(concat_ws(' ', case when c_custkey % 5 <> 0 then '9999 ZZ' end,
        case when c_custkey % 7 <> 0 then 'Assen' end), '')), '')"""


@query("trustee_address", f"""select c_custkey,
      case when c_custkey % 3 <> 0 then {_PLACE} end as first_address,
      case when c_custkey % 3 <> 0 then '06' end as first_phone,
      case when c_custkey % 4 = 0 then {_PLACE} end as second_address from ({_CASES})""")
def _(s: Source) -> DataFrame:
    curators = F.col("record.curators")
    return _decoded(s).select(
        "c_custkey", F.get(curators, F.lit(0))["address"].alias("first_address"),
        F.get(curators, F.lit(0))["phone"].alias("first_phone"),
        F.get(curators, F.lit(1))["address"].alias("second_address"))


@query("record_key", f"""select c_custkey, coalesce(concat('P', cast(first_order as varchar)), query_id)
      as kenmerk from ({_CASES})""")
def _(s: Source) -> DataFrame:
    return _decoded(s).select("c_custkey", "record.kenmerk")


_TRADES = """case when c_custkey % 3 = 0 then concat('Los BV|Zaak ', cast(c_custkey as varchar), '|Klaver')
      else '' end"""


@query("decode_case", f"""select c_custkey, type, kvk_nummer, name, {_TRADES} as trade_names,
      n_orders as n_publications,
      case when c_custkey % 10 <> 0 then concat('F.01/01/', cast(c_custkey as varchar)) else '' end
        as insolventienummer, 'Rechtbank Assen' as court,
      case when c_custkey % 2 = 0 then 'mr. R' else '' end as judge from ({_CASES})""")
def _(s: Source) -> DataFrame:
    r = F.col("record")
    return _decoded(s).select(
        "c_custkey", r["type"].alias("type"), r["debtor"]["kvk_nummer"].alias("kvk_nummer"),
        r["debtor"]["name"].alias("name"),
        F.array_join(r["debtor"]["trade_names"], "|").alias("trade_names"),
        F.size(r["publications"]).cast("bigint").alias("n_publications"),
        r["insolventienummer"].alias("insolventienummer"), r["court"].alias("court"),
        r["judge"].alias("judge"))


@query("decode_case_publications", f"""select c_custkey, concat('P', cast(o_orderkey as varchar)) as kenmerk,
      cast(cast(o_orderdate as date) as varchar) as date, 'einde' as event_type,
      concat(cast(year(o_orderdate) as varchar), '-05-', lpad(cast(day(o_orderdate) as varchar), 2, '0'))
        as event_date, 'faillissement' as insolvency_type
    from ({_CASES}) c join {{orders}} on c_custkey = o_custkey""")
def _(s: Source) -> DataFrame:
    return _decoded(s).select("c_custkey", F.explode("record.publications").alias("p")).select(
        "c_custkey", "p.kenmerk", "p.date", "p.event_type", "p.event_date", "p.insolvency_type")


def _hash(v: str) -> str:
    return f"substr(sha256(concat('{SALT}', {v})), 1, 12)"


_HIDDEN = f"""select *, type <> 'company' as is_anonymized,
      case when type = 'company' then name else {_hash('name')} end as shown,
      case when c_custkey % 3 <> 0 then '' when type = 'person' then concat_ws('|',
          {_hash("'Los BV'")}, {_hash("concat('Zaak ', cast(c_custkey as varchar))")},
          {_hash("'Klaver'")}) else {_TRADES} end as trade_names,
      cast(case when c_custkey % 2 = 0 and type <> 'person' then 1 else 0 end
        + case when c_custkey % 5 <> 1 and type = 'company' then 1 else 0 end
        + case when c_custkey % 15 = 0 and type <> 'person' then 1 else 0 end as bigint) as n_streets,
      cast(case when c_custkey % 2 = 0 then 1 else 0 end
        + case when c_custkey % 5 <> 1 then 1 else 0 end
        + case when c_custkey % 15 = 0 then 1 else 0 end as bigint) as n_cities from ({_CASES})"""
_HIDDEN_COLUMNS = ("c_custkey, type, is_anonymized, shown as name, trade_names, n_streets, "
                   "n_cities, kvk_nummer")


def _hidden_columns(record: Column) -> list[Column]:
    addresses = record["debtor"]["addresses"]
    return [
        record["type"].alias("type"), record["is_anonymized"].alias("is_anonymized"),
        record["debtor"]["name"].alias("name"),
        F.array_join(record["debtor"]["trade_names"], "|").alias("trade_names"),
        F.size(F.filter(addresses, lambda a: a["street"].isNotNull()
                        & a["number"].isNotNull() & a["postcode"].isNotNull()))
        .cast("bigint").alias("n_streets"),
        F.size(F.filter(addresses, lambda a: a["city"].isNotNull())).cast("bigint")
        .alias("n_cities"),
        record["debtor"]["kvk_nummer"].alias("kvk_nummer")]


@query("anonymize_cases", f"select {_HIDDEN_COLUMNS} from ({_HIDDEN})")
def _(s: Source) -> DataFrame:
    hidden = payloads.anonymise(_decoded(s), SALT)
    return hidden.select("c_custkey", *_hidden_columns(F.col("record")))


# -------------------------------------------------------------------------------- reports


def report_replies(s: Source) -> DataFrame:
    """Report lists per case number in three envelopes; lines of the customer's orders."""
    lines = s.sql("""select o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
        l_returnflag from {lineitem} join {orders} on l_orderkey = o_orderkey""")
    item = F.struct(
        F.when(F.col("l_partkey") % 10 == 0, "").otherwise(F.concat(
            "l_orderkey", F.lit("_"), "l_linenumber", F.lit("_"), "l_partkey", F.lit("_"),
            "l_suppkey")).alias("VerslagKenmerk"),
        F.concat(F.lit("/Date("), F.unix_millis(F.col("l_shipdate").cast("timestamp")),
                 F.lit(")/")).alias("DatumVerslagen"),
        F.when(F.col("l_returnflag") == "R", F.concat(
            F.lit("Financieel verslag  "), F.date_format("l_shipdate", "dd-MM-yyyy")))
        .alias("Titel"))
    k = F.col("o_custkey")
    items = F.to_json(F.collect_list(item))
    bodies = lines.groupBy(k).agg(items.alias("items"))
    body = (F.when(k % 4 == 0, F.col("items"))
            .when(k % 4 == 1, _wrap('{"model": ', F.col("items"), "}"))
            .when(k % 4 == 2, _wrap('{"model": {"items": ', F.col("items"), "}}"))
            .otherwise(_wrap('{"items": ', F.col("items"), "}")))
    return bodies.select(F.concat(F.lit("F.01/01/"), k).alias("insolventienummer"),
                         body.alias("body"))


_REPORTS = f"""select c_custkey, coalesce(concat('P', cast(first_order as varchar)), query_id)
      as kenmerk, replace({_LINE_ID}, '.', '_') as document_kenmerk,
      cast(cast(l_shipdate as date) as varchar) as document_date,
      case when l_returnflag = 'R' then 'Financieel verslag' else 'Verslag' end as document_type
    from ({_CASES}) c join {{orders}} on c_custkey = {{orders}}.o_custkey
      join {{lineitem}} on l_orderkey = o_orderkey
    where type = 'company' and c_custkey % 10 <> 0 and l_partkey % 10 <> 0"""


@query("decode_reports", f"""select kenmerk, document_kenmerk, document_date, document_type
    from ({_REPORTS})""")
def _(s: Source) -> DataFrame:
    found = _decoded(s).select("record.kenmerk", "record.type", "record.insolventienummer")
    out = payloads.decode_reports(found, report_replies(s))
    return out.withColumn("document_date", F.col("document_date").cast("string"))


@query("normalise_cases", f"""select c.kenmerk, status, entity_type, name, coalesce(n, 0) as n_documents
    from (select concat('Q', cast(c_custkey as varchar)) as kenmerk, 'ok' as status,
        type as entity_type, shown as name, c_custkey from ({_HIDDEN})
      union all select concat('Q', cast(c_custkey as varchar)),
        case when c_custkey % 23 = 20 then 'purged' else 'fetch_failed' end, '', null, c_custkey
        from {{customer}} where c_custkey % 23 >= 20) c
    left join (select c_custkey, count(*) as n from ({_REPORTS}) group by 1) d
      on c.c_custkey = d.c_custkey""")
def _(s: Source) -> DataFrame:
    """Every reply has arrived twice; a payload stays one row."""
    replies = report_replies(s)
    rows = payloads.normalise_cases(payload_rows(s), SALT, replies.unionByName(replies))
    back = rawlog.with_record(rows)
    return back.select(
        "kenmerk", "status", "entity_type", F.col("record.debtor.name").alias("name"),
        F.coalesce(F.size("record.documents"), F.lit(0)).cast("bigint").alias("n_documents"))


# --------------------------------------------------------------------------------- probes


@query("probe_rows", """select concat('F.', cast(c_custkey as varchar)) as insolventienummer,
      case c_custkey % 7 when 0 then 'found' when 1 then 'found' when 2 then 'not_found'
        when 3 then 'not_found' else 'error' end as status,
      case when c_custkey % 7 < 2 then c_custkey % 50 + 1 else 0 end as aantal,
      case when c_custkey % 7 = 0 then concat('P', cast(c_custkey as varchar)) else '' end
        as publicatiekenmerk, case when c_custkey % 7 = 0 then 1 else 0 end as queued
    from {customer}""")
def _(s: Source) -> DataFrame:
    k = F.col("c_custkey")
    many = F.concat(F.lit('"aantalResultaten": '), k % 50 + 1)
    body = (F.when(k % 7 == 0, F.concat(
                F.lit('{"result": {"status": 1, "model": {'), many,
                F.lit(', "items": [{"publicatiekenmerk": "P'), k, F.lit('"}, {}]}}}')))
            .when(k % 7 == 1, F.concat(F.lit('{"status": 1, "model": {'), many,
                                       F.lit(', "items": [{}]}}')))
            .when(k % 7 == 2, F.concat(F.lit('{"result": {"status": 1, "model": {'), many,
                                       F.lit(', "items": []}}}')))
            .when(k % 7 == 3, '{"result": {"status": 1, "model": null}}')
            .when(k % 7 == 4, '{"result": {"status": 3}}')
            .when(k % 7 == 5, '{"result": ["x"]}')
            .otherwise(F.lit(None).cast("string")))
    out = payloads.classify_probe(s.table("customer").select(
        F.concat(F.lit("F."), k).alias("insolventienummer"), body.alias("body")))
    return out.withColumn("aantal", F.col("aantal").cast("bigint")).drop("error")


# -------------------------------------------------------------------------------- listing


def listing_pages(s: Source) -> DataFrame:
    """Hundred listed reports per page, in the site's markup with HTML entities.

    Some pages report a wrong offset, some one row too many, some have no result line.
    """
    rows = s.sql(f"""select *, coalesce({S.dmy('verslag_datum')}, '00-00-0000') as datum
        from ({listing(S)}) l""")
    row = F.concat(
        F.lit('<tr><td><a href="/faillissement/verslagen/verslag/'), "verslag_kenmerk",
        F.lit('" class="x">Details</a></td>\n <td nowrap="nowrap">'), "kvk_nummer",
        F.lit(' </td>\n<td nowrap="nowrap" class="sorting_1">'), "datum",
        F.lit('</td><td nowrap="nowrap"><span title="Caf&eacute; &amp; Zn '), "c_name",
        F.lit('">kort<b>x</b></span></td>\n<td nowrap="nowrap">'),
        F.replace("city", F.lit("'"), F.lit("&#39;")), F.lit("</td></tr>\n"))
    grouped = rows.groupBy("page").agg(
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.struct("c_custkey", row.alias("row")))).alias("rows"))
    page = F.col("page")
    start = (page - 1) * 100 + F.when(page % 5 == 0, 2).otherwise(1)
    end = start + F.col("n") - F.when(page % 7 == 0, 0).otherwise(1)
    line = F.concat(F.lit("<div>Resulaten "), F.translate(F.format_number(start, 0), ",", "."),
                    F.lit(" tot "), F.translate(F.format_number(end, 0), ",", "."),
                    F.lit(" van 705.123</div>"))
    html = F.concat(F.lit("<table>"), F.array_join(F.transform("rows", lambda r: r["row"]), ""),
                    F.lit("</table>"), F.when(page % 11 == 0, "").otherwise(line))
    return grouped.select("page", html.alias("html"))


@query("parse_listing_html", f"""select page, c_custkey % 100 as position, verslag_kenmerk, kvk_nummer,
      cast(verslag_datum as varchar) as verslag_datum, concat('Café & Zn ', c_name) as company_name,
      city from ({listing(D)}) l""")
def _(s: Source) -> DataFrame:
    out = pages.parse_listing(listing_pages(s))
    return out.withColumns({"verslag_datum": F.col("verslag_datum").cast("string"),
                            "position": F.col("position").cast("bigint")})


@query("audit_listing_pages", f"""select page, n as parsed, case when page % 11 = 0 then null
        else 705123 end as total, case when page % 11 = 0 then 'no result line'
      when page % 5 = 0 then 'wrong offset' when page % 7 = 0 then 'row count' else 'ok' end
      as verdict from (select page, count(*) as n from ({listing(D)}) l group by page)""")
def _(s: Source) -> DataFrame:
    return pages.audit_listing(listing_pages(s)).select(
        "page", F.col("parsed").cast("bigint").alias("parsed"), "total", "verdict")


@query("listing_of_other_pages", "select cast(0 as bigint) as rows, count(*) as pages from {pages}")
def _(s: Source) -> DataFrame:
    """Web pages of other sites hold no listing rows; every page is read in full."""
    other = s.table("pages").select(F.col("page_id").alias("page"), "html")
    return pages.audit_listing(other).agg(
        F.sum("parsed").cast("bigint").alias("rows"),
        F.count_if(F.col("verdict") == "no result line").alias("pages"))

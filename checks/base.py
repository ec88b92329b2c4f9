"""Registry of check queries and the derived tables they run on.

Ingredients (plain columns, money, counts) are written once as SQL for both engines.  Spark then
renders text or JSON from them and parses it back with the library; the SQL answer is computed
from the ingredients and never parses anything.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from estatelens.vocab import COURTS, EVENT_TYPES, OLD_COURT_NUMBERS

TABLES = ("customer", "documents", "events", "lineitem", "nation", "orders", "pages", "part",
          "supplier")


@dataclass(frozen=True)
class Source:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers ``fn(source)`` under a name; ``sql`` is its DuckDB answer."""

    def register(fn: Callable[[Source], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Source(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql.format(**{t: t for t in TABLES})
        return fn

    return register


# ------------------------------------------------------------------------------- dialects


class SparkSql:
    @staticmethod
    def plus_seconds(ts: str, n: str) -> str:
        return f"({ts} + make_dt_interval(0, 0, 0, {n}))"

    @staticmethod
    def plus_days(day: str, n: str) -> str:
        return f"date_add({day}, cast({n} as int))"

    @staticmethod
    def div(a: str, b: int) -> str:
        return f"({a} div {b})"

    @staticmethod
    def pick(values: list, index: str) -> str:
        return f"element_at(array({', '.join(map(quoted, values))}), cast({index} + 1 as int))"

    @staticmethod
    def dmy(day: str) -> str:
        return f"date_format({day}, 'dd-MM-yyyy')"


class DuckSql:
    @staticmethod
    def plus_seconds(ts: str, n: str) -> str:
        return f"({ts} + to_seconds({n}))"

    @staticmethod
    def plus_days(day: str, n: str) -> str:
        return f"({day} + cast({n} as integer))"

    @staticmethod
    def div(a: str, b: int) -> str:
        return f"({a} // {b})"

    @staticmethod
    def pick(values: list, index: str) -> str:
        return f"list_extract([{', '.join(map(quoted, values))}], cast({index} + 1 as integer))"

    @staticmethod
    def dmy(day: str) -> str:
        return f"strftime({day}, '%d-%m-%Y')"


def quoted(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


S, D = SparkSql, DuckSql

# ---------------------------------------------------------------------------- ingredients

CASE_OF_ORDER = "concat('K', cast(o_custkey * 4 + o_orderkey % 4 as string))"
CASE_OF_CUSTOMER = "concat('K', cast(c_custkey * 4 as string))"
ENTITY = ("case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'company' "
          "when c_mktsegment = 'AUTOMOBILE' then 'eenmanszaak' else 'person' end")


def raw(d) -> str:
    """Attempt log, one row per order."""
    return f"""select {CASE_OF_ORDER} as kenmerk,
        {d.plus_seconds('o_orderdate', 'o_orderkey % 86400')} as scraped_at,
        case o_orderstatus when 'F' then 'ok' when 'O' then 'fetch_failed'
          else case when o_orderkey % 10 = 0 then 'purged' else 'parse_failed' end end as status,
        case when o_orderstatus <> 'F' then '' else {ENTITY} end as entity_type,
        o_orderkey, o_custkey
      from {{orders}} join {{customer}} on o_custkey = c_custkey"""


def court(d, key: str = "c_custkey") -> str:
    return d.pick(COURTS, f"{key} % 11")


def candidates(d) -> str:
    """Four possible ids per customer, with and without attempts."""
    return " union all ".join(
        f"select concat('K', cast(c_custkey * 4 + {v} as string)) as kenmerk, "
        f"{court(d)} as court from {{customer}}" for v in range(4))


def pubs(d) -> str:
    """Publication rows, one per order line; several versions of a key occur."""
    labels = d.pick([label for _, label in EVENT_TYPES], "l_partkey % 15")
    words = d.pick([word for word, _ in EVENT_TYPES], "l_partkey % 15")
    return f"""select {CASE_OF_ORDER} as kenmerk,
        concat({CASE_OF_ORDER}, '.', cast(l_orderkey as string), '.',
               cast(l_linenumber as string)) as publicatie_kenmerk,
        {words} as keyword, {labels} as event_type,
        cast(l_shipdate as date) as publicatie_datum,
        {d.plus_seconds('l_shipdate', '(l_partkey * 7 + l_suppkey) % 86400')} as scraped_at,
        l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate
      from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey"""


def docs(d) -> str:
    """Report metadata, one row per order line."""
    return f"""select {CASE_OF_ORDER} as kenmerk,
        concat(cast(l_orderkey as string), '_', cast(l_linenumber as string), '_',
               cast(l_partkey as string), '_', cast(l_suppkey as string)) as document_kenmerk,
        case when l_partkey % 20 = 0 then null else cast(l_shipdate as date) end
          as document_date,
        case when l_returnflag = 'R' then 'Financieel verslag'
             when l_partkey % 9 = 0 then 'Tussentijds financieel verslag'
             else 'Verslag' end as document_type,
        l_shipdate as scraped_at
      from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey"""


def case_number(d, key: str = "c_custkey") -> str:
    return (f"concat('F.', lpad(cast({key} % 19 + 1 as string), 2, '0'), '/', "
            f"lpad(cast({key} % 30 as string), 2, '0'), '/', cast({key} as string))")


def cases(d) -> str:
    """Case rows, one version per order of the customer; the court differs between versions."""
    return f"""select {CASE_OF_CUSTOMER} as kenmerk, {case_number(d)} as insolventienummer,
        {ENTITY} as type, {d.pick(COURTS, '(c_custkey + o_orderkey % 2) % 11')} as court,
        case when c_custkey % 11 = 0 then null when c_custkey % 13 = 0 then ''
             else lpad(cast(c_custkey % 150 as string), 8, '0') end as kvk_nummer,
        c_name as debtor_name, {d.plus_seconds('o_orderdate', 'o_orderkey % 86400')}
          as scraped_at, o_orderkey
      from {{orders}} join {{customer}} on o_custkey = c_custkey"""


OLD_ABBRS = list(OLD_COURT_NUMBERS)
OLD_NUMBERS = [f"{n:02d}" for n in OLD_COURT_NUMBERS.values()]


def listing(d) -> str:
    """Listed reports: new and old id forms in both spellings, unknown courts, junk."""
    abbr = d.pick(OLD_ABBRS, d.div("c_custkey", 4) + " % 21")
    old_nr = d.pick(OLD_NUMBERS, d.div("c_custkey", 4) + " % 21")
    yy = "lpad(cast(c_custkey % 100 as string), 2, '0')"
    nr = "lpad(cast(c_custkey % 19 + 1 as string), 2, '0')"
    key = "cast(c_custkey as string)"
    padded = f"lpad({key}, 9, '0')"
    return f"""select *, case form when 0 then concat(nr, '_rot_', yy, '_', serial, '_F')
            when 1 then concat(abbr, '.', yy, '.', serial, '.F')
            when 2 then concat('xyz.', yy, '.', serial, '.F') else '' end as case_key,
        case form when 0 then concat('F.', nr, '/', yy, '/', serial)
            when 1 then concat('F.', old_nr, '/', yy, '/', bare) else '' end
            as insolventienummer
      from (select c_custkey, c_name, c_nationkey, c_custkey % 4 as form, {nr} as nr,
        {yy} as yy, {abbr} as abbr, {old_nr} as old_nr, {key} as bare,
        case when c_custkey % 4 = 1 then {padded} else {key} end as serial,
        case c_custkey % 4
          when 0 then case when c_custkey % 8 = 4
            then concat({nr}, '.rot.', {yy}, '.', {key}, '.F.V.02.B')
            else concat({nr}, '_rot_', {yy}, '_', {key}, '_F_V_02_B') end
          when 1 then case when c_custkey % 8 = 5
            then concat({abbr}, '_', {yy}, '_', {padded}, '_F_V_01')
            else concat({abbr}, '.', {yy}, '.', {padded}, '.F.V.01') end
          when 2 then concat('xyz_', {yy}, '_', {key}, '_F_V_01')
          else concat('junk-', {key}) end as verslag_kenmerk,
        lpad(cast(c_custkey % 150 as string), 8, '0') as kvk_nummer,
        case when c_custkey % 17 = 0 then null
             else {d.plus_days("date '2010-01-01'", 'c_custkey % 5000')} end as verslag_datum,
        {d.pick(['Utrecht', "'s-Gravenhage", 'Súdwest-Fryslân'], 'c_custkey % 3')} as city,
        {d.div('c_custkey', 100)} + 1 as page
      from {{customer}}) t"""


def probes(d) -> str:
    """Probe results for part of the numbers."""
    return f"""select insolventienummer,
        case when c_custkey % 5 = 0 then 'error' when c_custkey % 5 < 3 then 'found'
             else 'not_found' end as status,
        case when c_custkey % 5 in (1, 2) then 1 else 0 end as queued
      from ({listing(d)}) l where insolventienummer <> '' and c_nationkey < 9"""

"""Listing pages of published reports: parsing, page audit and derived case numbers."""

from __future__ import annotations

import html
import json
from collections.abc import Sequence
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from estatelens.functions.casenumber import derive_case_number
from estatelens.functions.dates import dmy_date
from estatelens.functions.text import strip

PAGE_SIZE = 100

# --- fixed values: markup of one table row and of the result line ---
ROW = (
    r'(?s)<a href="/faillissement/verslagen/verslag/([^"]+)"[^>]*>Details</a></td>\s*'
    r'<td nowrap="nowrap">([^<]*)</td>\s*'
    r'<td nowrap="nowrap" class="sorting_1">([\d-]+)</td>\s*'
    r'<td nowrap="nowrap"><span title="([^"]*)">.*?</span></td>\s*'
    r'<td nowrap="nowrap">([^<]*)</td>'
)
RESULT_LINE = r"Resulaten ([\d.]+) tot ([\d.]+) van ([\d.]+)"


#: What one token decides: names with their semicolon, and printable ASCII by its number.
ENTITIES = json.dumps({f"&{name}": text for name, text in html5.items() if name.endswith(";")}
                      | {f"&#{n};": chr(n) for n in range(32, 127)})
#: An entity as HTML reads it, an ampersand that begins none, or the text up to the next.
TOKEN = r"&[^\t\n\f <&#;]{1,32};?|&#[^\t\n\f <&;]*;?|&|[^&]+"


@F.pandas_udf(StringType())
def _unescape(cells: pd.Series) -> pd.Series:
    """The rest of HTML's rules: names without semicolon, other numbers; NULL stays NULL."""
    return cells.map(html.unescape, na_action="ignore")


def unescaped(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """``rows`` with the HTML entities of the text columns ``names`` decoded.

    Tokens are looked up in a map literal.  Only cells with an entity that it lacks reach Python;
    for all others Python is handed NULL.
    """
    table = F.from_json(F.lit(ENTITIES), "map<string,string>")
    plain, rest = {}, {}
    for name in names:
        cell = F.col(name)
        tokens = F.regexp_extract_all(cell, F.lit(TOKEN), F.lit(0))
        known = F.array_join(F.transform(
            tokens, lambda t: F.coalesce(F.try_element_at(table, t), t)), "")
        unknown = F.exists(tokens, lambda t: t.startswith("&") & (t != "&")
                           & F.try_element_at(table, t).isNull())
        entity = F.contains(cell, F.lit("&"))
        plain[name] = F.when(entity, known).otherwise(cell)
        rest[f"_rest_{name}"] = F.when(entity & unknown, cell)
    staged = rows.withColumns(rest | plain)
    return staged.withColumns({
        name: F.coalesce(_unescape(f"_rest_{name}"), F.col(name)) for name in names}).drop(*rest)


def parse_listing(pages: DataFrame) -> DataFrame:
    """(page, html) to one row per listed report."""
    hits = pages.select("page", F.posexplode(
        F.regexp_extract_all("html", F.lit(ROW), F.lit(0))).alias("position", "row"))
    raw = hits.select("page", "position",
                      *[F.regexp_extract("row", ROW, i).alias(f"c{i}") for i in range(1, 6)])
    return unescaped(raw, ["c1", "c4", "c5"]).select(
        "page", "position",
        strip(F.col("c1")).alias("verslag_kenmerk"),
        strip(F.col("c2")).alias("kvk_nummer"),
        dmy_date(strip(F.col("c3"))).alias("verslag_datum"),
        strip(F.col("c4")).alias("company_name"),
        strip(F.col("c5")).alias("city"))


def _count(group: int) -> Column:
    text = F.regexp_extract("html", RESULT_LINE, group)
    return F.replace(text, F.lit("."), F.lit("")).try_cast("bigint")


def audit_listing(pages: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """One verdict per page: 'ok' or the first check that fails."""
    staged = pages.select(
        "page", _count(1).alias("first_row"), _count(2).alias("last_row"),
        _count(3).alias("total"),
        F.size(F.regexp_extract_all("html", F.lit(ROW), F.lit(0))).alias("parsed"))
    expected = (F.col("page") - 1) * page_size + 1
    verdict = (
        F.when(F.col("first_row").isNull() | F.col("last_row").isNull(), "no result line")
        .when(F.col("first_row") != expected, "wrong offset")
        .when(F.col("parsed") == 0, "no rows")
        .when(F.col("parsed") != F.col("last_row") - F.col("first_row") + 1, "row count")
        .otherwise("ok"))
    return staged.withColumn("verdict", verdict)


def number_listing(rows: DataFrame) -> DataFrame:
    """Adds case_key and insolventienummer read from the report id."""
    derived = rows.withColumn("_d", derive_case_number(F.col("verslag_kenmerk")))
    return derived.select(*rows.columns, "_d.case_key", "_d.insolventienummer")


def to_listing(rows: DataFrame) -> DataFrame:
    """Parsed rows in the column order of the listing table."""
    return number_listing(rows).select(
        "verslag_kenmerk", "case_key", "insolventienummer", "kvk_nummer", "verslag_datum",
        "company_name", "city", "page")

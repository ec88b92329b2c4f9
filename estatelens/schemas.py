"""Row schemas and table declarations (replace key, version column, partition month)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """How a table collapses to its live rows and how it is laid out at rest."""

    name: str
    key: tuple[str, ...]
    version: str
    month_of: str | None = None  # timestamp column the month partition is derived from
    sort: tuple[str, ...] = ()


RAW_CASES = TableSpec("raw_cases", ("kenmerk", "scraped_at"), "scraped_at", "scraped_at",
                      ("scraped_at", "kenmerk"))
CASES = TableSpec("processed_cases", ("court", "type", "kenmerk"), "scraped_at", "scraped_at")
PUBLICATIONS = TableSpec("processed_publications", ("kenmerk", "publicatie_kenmerk"),
                         "scraped_at", "scraped_at")
DOCUMENTS = TableSpec("processed_documents", ("kenmerk", "document_kenmerk"),
                      "scraped_at", "scraped_at")
MALFORMED = TableSpec("malformed_records", ("kenmerk", "scraped_at"), "scraped_at", "scraped_at")
SNAPSHOT = TableSpec("kvk_snapshot", ("kvk_nummer",), "snapshot_at")
PROFILE = TableSpec("processed_profile", ("kenmerk",), "extracted_at")
REVENUE = TableSpec("processed_revenue", ("kenmerk", "jaar"), "extracted_at")
ASSET_SALES = TableSpec("processed_asset_sales", ("kenmerk", "categorie"), "extracted_at")
DEBT = TableSpec("processed_debt", ("kenmerk",), "extracted_at")
RELATIONS = TableSpec("processed_relations", ("kenmerk", "relatie", "company_name"),
                      "extracted_at")
MINED = TableSpec("mined_reports", ("document_kenmerk", "text_digest"), "mined_at")
LISTING = TableSpec("fv_listing", ("verslag_kenmerk",), "fetched_at")
PROBES = TableSpec("backfill_probe", ("insolventienummer",), "probed_at")


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


ADDRESS = T.StructType(_strings("type", "street", "number", "postcode", "city"))
DEBTOR = T.StructType(_strings("name", "kvk_nummer") + [
    T.StructField("trade_names", T.ArrayType(T.StringType())),
    T.StructField("addresses", T.ArrayType(ADDRESS)),
])
CURATOR = T.StructType(_strings("name", "address", "phone"))
PUBLICATION = T.StructType(_strings("date", "kenmerk", "description", "event_type",
                                    "event_subtype", "event_date", "insolvency_type"))
DOCUMENT = T.StructType(_strings("kenmerk", "date", "type", "pdf_path"))

# The JSON record carried by the attempt log.
RECORD = T.StructType(
    _strings("kenmerk", "insolventienummer", "toezichtzaaknummer", "type", "court", "judge")
    + [
        T.StructField("is_anonymized", T.BooleanType()),
        T.StructField("debtor", DEBTOR),
        T.StructField("curators", T.ArrayType(CURATOR)),
        T.StructField("publications", T.ArrayType(PUBLICATION)),
        T.StructField("documents", T.ArrayType(DOCUMENT)),
        T.StructField("scraped_at", T.StringType()),
    ]
)

RAW_ROW = T.StructType(_strings("kenmerk") + [T.StructField("scraped_at", T.TimestampType())]
                       + _strings("status", "entity_type", "error", "record", "git_sha"))

# The register's own case payload.
_API_ADDRESS = T.ArrayType(T.StructType(_strings(
    "straat", "huisnummer", "huisnummerToevoeging1", "huisnummerToevoeging2",
    "postcode", "plaats")))
_API_TRUSTEE = T.ArrayType(T.StructType(
    _strings("titulatuur", "voorletters", "voorvoegsel", "achternaam") + [
        T.StructField("adres", T.StructType(_strings(
            "straat", "huisnummer", "postcode", "plaats", "telefoonnummer")))]))
API_TRADE_NAME = T.StructType(_strings("handelsnaam", "KvKNummer") + [
    T.StructField("vestigingsadressen", _API_ADDRESS),
    T.StructField("correspondentieadressen", _API_ADDRESS),
])
API_MODEL = T.StructType([
    # a map, because two of its keys differ by case only
    T.StructField("persoon", T.MapType(T.StringType(), T.StringType())),
    T.StructField("vestigingsadressen", _API_ADDRESS),
    T.StructField("woonadressen", _API_ADDRESS),
    T.StructField("correspondentieadressen", _API_ADDRESS),
    # elements are objects or bare strings, so each is kept as JSON text
    T.StructField("handelendOnderDeNamen", T.ArrayType(T.StringType())),
    T.StructField("curators", _API_TRUSTEE),
    T.StructField("bewindvoerders", _API_TRUSTEE),
    T.StructField("publicatiegeschiedenis", T.ArrayType(T.StructType(_strings(
        "publicatieDatum", "publicatieKenmerk", "publicatieOmschrijving")))),
] + _strings("landelijkUniekZaaknummer", "toezichtZaaknummer", "behandelendeInstantieNaam", "RC"))
API_CASE = T.StructType([T.StructField("model", API_MODEL)])

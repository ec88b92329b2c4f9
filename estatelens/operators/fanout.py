"""Record to table rows: cases, publications, documents, and the extraction tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.functions.dates import iso_date_clamp
from estatelens.functions.text import blank_to_null, filled
from estatelens.schemas import ASSET_SALES, DEBT, PROFILE, RELATIONS, REVENUE
from estatelens.sources.tables import stamped, write_table

ADDRESS_PREFERENCE = ["vestiging", "woon", "correspondentie"]


def pick_city(addresses: Column) -> Column:
    """First non-empty city, by address type preference, then any."""
    with_city = F.filter(addresses, lambda a: filled(a["city"]))
    ranked = [F.get(F.filter(with_city, _of_type(kind)), F.lit(0))["city"]
              for kind in ADDRESS_PREFERENCE]
    return F.coalesce(*ranked, F.get(with_city, F.lit(0))["city"])


def _of_type(kind: str):
    return lambda a: a["type"] == kind


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _case_id() -> Column:
    # the record's own id wins over the id it was fetched by
    return F.coalesce(blank_to_null(F.col("record.kenmerk")), F.col("kenmerk"))


def to_cases(decoded: DataFrame) -> DataFrame:
    """One row per record.  Text columns that may not be NULL hold ''."""
    r = F.col("record")
    return decoded.select(
        _case_id().alias("kenmerk"), F.col("kenmerk").alias("task_kenmerk"),
        *[_text(r[c]).alias(c) for c in ("insolventienummer", "toezichtzaaknummer", "type",
                                         "court", "judge")],
        F.coalesce(r["is_anonymized"], F.lit(False)).alias("is_anonymized"),
        _text(r["debtor"]["name"]).alias("debtor_name"),
        r["debtor"]["kvk_nummer"].alias("kvk_nummer"),
        pick_city(r["debtor"]["addresses"]).alias("city"),
        F.coalesce(F.transform(r["curators"], lambda c: _text(c["name"])),
                   F.array().cast("array<string>")).alias("curator_names"),
        F.coalesce(F.size(r["publications"]), F.lit(0)).alias("publication_count"),
        F.coalesce(F.size(r["documents"]), F.lit(0)).alias("document_count"),
        "scraped_at")


def to_publications(decoded: DataFrame) -> DataFrame:
    rows = decoded.select(_case_id().alias("kenmerk"), F.col("kenmerk").alias("task_kenmerk"),
                          "scraped_at", F.explode("record.publications").alias("p"))
    return rows.select(
        "kenmerk", "task_kenmerk", _text(F.col("p.kenmerk")).alias("publicatie_kenmerk"),
        iso_date_clamp(F.col("p.date")).alias("publicatie_datum"),
        _text(F.col("p.description")).alias("description"),
        _text(F.col("p.event_type")).alias("event_type"),
        F.col("p.event_subtype").alias("event_subtype"),
        iso_date_clamp(F.col("p.event_date")).alias("event_date"),
        _text(F.col("p.insolvency_type")).alias("insolvency_type"), "scraped_at")


def to_documents(decoded: DataFrame) -> DataFrame:
    rows = decoded.select(_case_id().alias("kenmerk"), F.col("kenmerk").alias("task_kenmerk"),
                          "scraped_at", F.explode("record.documents").alias("d"))
    return rows.select(
        "kenmerk", "task_kenmerk", _text(F.col("d.kenmerk")).alias("document_kenmerk"),
        iso_date_clamp(F.col("d.date")).alias("document_date"),
        _text(F.col("d.type")).alias("document_type"),
        F.col("d.pdf_path").alias("pdf_path"), "scraped_at")


# ------------------------------------------------------------------------ extraction tables

PROFILE_TEXT = ["insolventienummer", "sector", "activiteiten", "oorzaak", "oorzaak_categorie",
                "afwikkeling"]
PROFILE_LISTS = ["domeinnamen", "bestuurders_gehasht"]
PROFILE_OPTIONAL = ["kvk_nummer", "doorstart", "overnemer", "ie_rechten", "koopsom",
                    "koopsom_toelichting", "personeel_ttv", "personeel_jaar_voor",
                    "onroerend_goed", "huurpand", "boekhoudplicht_voldaan",
                    "depot_jaarrekeningen_ok", "onbehoorlijk_bestuur", "paulianeus_handelen"]
DEBT_COLUMNS = ["boedelvorderingen", "pref_fiscus", "pref_uwv", "pref_overig", "pref_totaal",
                "concurrent_bedrag", "concurrent_aantal"]


def to_profile(records: DataFrame, model: str = "", extra: Sequence[str] = ()) -> DataFrame:
    """One row per case: '' and [] for missing text and lists, NULL for missing flags.

    ``extra`` names further columns to pass through.
    """
    none = F.array().cast("array<string>")
    return records.select(
        "kenmerk",
        *[_text(F.col(c)).alias(c) for c in PROFILE_TEXT],
        *[F.coalesce(c, none).alias(c) for c in PROFILE_LISTS],
        *PROFILE_OPTIONAL,
        *[F.col(f"boedel.{c}").alias(c) for c in (
            "saldo_boedelrekening", "definitief_saldo", "beschikbaar_voor_uitdeling")],
        F.col("creditors.preferente.recovery_pct").alias("pref_recovery_pct"),
        F.col("creditors.concurrente.recovery_pct").alias("conc_recovery_pct"),
        F.lit(model).alias("model"), *extra)


def to_revenue(records: DataFrame) -> DataFrame:
    rows = records.select("kenmerk", F.explode("omzet_historie").alias("r"))
    return rows.filter("r.jaar is not null and r.jaar != 0").select("kenmerk", "r.*")


def to_asset_sales(records: DataFrame) -> DataFrame:
    return records.select("kenmerk", F.explode("asset_realizations").alias(
        "categorie", "verkoopopbrengst"))


def to_debt(records: DataFrame) -> DataFrame:
    """Only cases with any claim or a creditor count."""
    rows = records.select("kenmerk", *[F.col(f"debt.{c}").alias(c) for c in DEBT_COLUMNS])
    return rows.filter(F.coalesce(*[F.col(c).cast("double") for c in DEBT_COLUMNS]).isNotNull())


def to_relations(records: DataFrame) -> DataFrame:
    rows = records.select("kenmerk", F.explode("relations").alias("r"))
    return rows.select("kenmerk", "r.relatie", "r.company_name", "r.detail")


EXTRACTED = {
    "processed_profile": PROFILE, "processed_revenue": REVENUE,
    "processed_asset_sales": ASSET_SALES, "processed_debt": DEBT,
    "processed_relations": RELATIONS,
}


def write_extraction(records: DataFrame, folder: str, at: datetime, model: str = "") -> None:
    """Extraction records to their five tables below ``folder``, stamped ``extracted_at``.

    Records are stored once, next to the tables, so sectioning, mining and checking run once.
    """
    stored = f"{folder}/records/extracted_at={at:%Y%m%dT%H%M%S%f}"
    records.write.mode("overwrite").parquet(stored)
    once = records.sparkSession.read.parquet(stored)
    rows = (to_profile(once, model), to_revenue(once), to_asset_sales(once), to_debt(once),
            to_relations(once))
    for (name, spec), table in zip(EXTRACTED.items(), rows):
        write_table(stamped(table, spec, at), f"{folder}/{name}", spec)

"""Append-only snapshot of company-registry data for cases on file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.operators.latest import latest_per_key
from estatelens.schemas import CASES

SOURCE_LABEL = "kvk_scrape_2026"


def new_registry_keys(cases: DataFrame, existing: DataFrame) -> DataFrame:
    """Registry numbers of live company and sole-trader cases without a snapshot."""
    live = latest_per_key(cases.select(*CASES.key, CASES.version, "kvk_nummer"),
                          CASES.key, CASES.version)
    keys = (live.filter(F.col("type").isin("company", "eenmanszaak")
                        & (F.col("kvk_nummer") != ""))
            .select("kvk_nummer").distinct())
    return keys.join(existing.select("kvk_nummer").distinct(), "kvk_nummer", "left_anti")


def activity_codes_agg(codes: DataFrame) -> DataFrame:
    """Per registry number: a main code, and all codes with their descriptions, aligned.

    Equal rows are counted first, so what meets in one task is the distinct codes of a company.
    """
    counted = codes.groupBy("kvk_nummer", "sbi_code", "sbi_description").agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.max("is_main_activity").alias("main"))
    per_key = counted.groupBy("kvk_nummer").agg(
        F.min(F.when(F.col("main"), F.col("sbi_code"))).alias("main_code"),
        F.array_sort(F.collect_list(F.struct("sbi_code", "sbi_description", "n"))).alias("all"))

    def column(field: str):
        return F.flatten(F.transform("all", lambda c: F.array_repeat(c[field], c["n"])))

    return per_key.select(
        "kvk_nummer", F.coalesce("main_code", F.lit("")).alias("sbi_hoofd"),
        column("sbi_code").alias("sbi_codes"), column("sbi_description").alias("sbi_descriptions"))


def longest_activity(businesses: DataFrame) -> DataFrame:
    """Per registry number the activity text that is longest in bytes, with its trade names."""
    text = F.col("activiteit_omschrijving")
    best = F.max(F.struct(F.octet_length(text).alias("bytes"), text.alias("text"),
                          F.col("huidige_handelsnamen").alias("names")))
    return businesses.groupBy("kvk_nummer").agg(
        best.alias("b"), F.min("rechtsvorm_omschrijving").alias("rechtsvorm")).select(
        "kvk_nummer", F.col("b.text").alias("activiteit_omschrijving"),
        F.col("b.names").alias("handelsnamen"), "rechtsvorm")


def registry_snapshot(cases: DataFrame, codes: DataFrame, businesses: DataFrame,
                      existing: DataFrame) -> DataFrame:
    """New snapshot rows: keys found in either registry table, gaps filled with '' and [].

    Both registry tables are reduced to the new keys before they are aggregated.
    """
    keys = new_registry_keys(cases, existing)
    found_codes = activity_codes_agg(codes.join(keys, "kvk_nummer", "left_semi")).withColumn(
        "has_codes", F.lit(True))
    found_business = longest_activity(
        businesses.join(keys, "kvk_nummer", "left_semi")).withColumn("has_business", F.lit(True))
    joined = (keys.join(found_codes, "kvk_nummer", "left")
              .join(found_business, "kvk_nummer", "left")
              .filter("has_codes is not null or has_business is not null"))
    none = F.array().cast("array<string>")
    return joined.select(
        "kvk_nummer",
        F.coalesce("sbi_hoofd", F.lit("")).alias("sbi_hoofd"),
        F.coalesce("sbi_codes", none).alias("sbi_codes"),
        F.coalesce("sbi_descriptions", none).alias("sbi_descriptions"),
        F.coalesce("activiteit_omschrijving", F.lit("")).alias("activiteit_omschrijving"),
        F.coalesce("handelsnamen", none).alias("handelsnamen"),
        F.coalesce("rechtsvorm", F.lit("")).alias("rechtsvorm"),
        F.lit(SOURCE_LABEL).alias("bron"))

"""Historical backfill: progress counters, court-number audit, legacy import."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.functions.casenumber import case_number, old_court_number
from estatelens.operators.latest import latest_per_key
from estatelens.operators.worklists import _succeeded
from estatelens.schemas import CASES, PUBLICATIONS


def status_counters(listing: DataFrame, probes: DataFrame) -> DataFrame:
    """(what, n) progress rows over the listing and the probes."""
    number = F.col("insolventienummer")
    sizes = listing.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("page").alias("pages"),
        F.count_distinct(F.nullif(number, F.lit(""))).alias("cases"),
        F.count_if(number == "").alias("underivable"))
    labelled = sizes.select(F.expr(
        "stack(4, 'fv_listing rows', rows, 'fv_listing pages', pages, "
        "'unique cases (derivable)', cases, 'rows underivable', underivable) as (what, n)"))
    per_status = probes.groupBy("status").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat(F.lit("probed "), "status").alias("what"), "n")
    pushed = probes.agg(F.coalesce(F.sum("queued"), F.lit(0)).cast("bigint").alias("n")).select(
        F.lit("tasks pushed").alias("what"), "n")
    return labelled.unionByName(per_status).unionByName(pushed)


def court_samples(listing: DataFrame) -> DataFrame:
    """One sample case per abbreviation among old-form case keys."""
    abbr = F.regexp_extract("case_key", r"^([a-z]{2,4})\.", 1)
    return (listing.select(abbr.alias("abbr"), "case_key").filter("abbr != ''")
            .groupBy("abbr").agg(F.min("case_key").alias("case_key")))


def court_map_audit(samples: DataFrame, observed: DataFrame) -> DataFrame:
    """Checks the court map: try the mapped number, then 1 to 19, against observed reports
    (insolventienummer, verslag_kenmerk); the first number with a report of that court wins."""
    mapped = old_court_number(F.col("abbr")).cast("int")
    parts = F.split("case_key", r"\.")
    tries = F.array_distinct(F.concat(
        F.filter(F.array(F.col("mapped")), lambda n: n.isNotNull()),
        F.sequence(F.lit(1), F.lit(19))))
    candidates = (
        samples.withColumn("mapped", mapped)
        .select("abbr", "case_key", "mapped", F.posexplode(tries).alias("rank", "court"))
        .withColumn("insolventienummer", case_number(
            F.get(parts, F.lit(3)), F.lpad(F.col("court").cast("string"), 2, "0"),
            F.get(parts, F.lit(1)), F.get(parts, F.lit(2)))))
    hits = (candidates.join(observed.select("insolventienummer", "verslag_kenmerk"),
                            "insolventienummer")
            .filter(F.startswith("verslag_kenmerk", F.col("abbr")))
            .groupBy("abbr").agg(F.min(F.struct("rank", "court")).alias("h"))
            .select("abbr", F.col("h.court").alias("actual")))
    judged = samples.withColumn("mapped", mapped).join(hits, "abbr", "left")
    return judged.select("abbr", "case_key", "mapped", "actual", F.when(
        F.col("mapped").eqNullSafe(F.col("actual")), "OK").otherwise("MISMATCH").alias("verdict"))


def distinct_ids(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n) exact distinct case ids per table."""
    counts = [df.agg(F.count_distinct("kenmerk").alias("n")).select(
        F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    total = counts[0]
    for other in counts[1:]:
        total = total.unionByName(other)
    return total


def import_legacy(legacy: DataFrame, raw: DataFrame, spec=CASES) -> DataFrame:
    """Live legacy rows of cases without a good attempt, ready to append."""
    live = latest_per_key(legacy, spec.key, spec.version)
    return live.join(_succeeded(raw), "kenmerk", "left_anti").select(*legacy.columns)


def import_legacy_publications(legacy: DataFrame, raw: DataFrame) -> DataFrame:
    return import_legacy(legacy, raw, PUBLICATIONS)

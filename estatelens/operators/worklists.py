"""Which cases to fetch, probe or extract next."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.functions.dates import case_year, period_start
from estatelens.operators.attempts import attempt_state, refreshed_kind
from estatelens.operators.latest import latest_per_key
from estatelens.schemas import DOCUMENTS
from estatelens.vocab import COURTS, TERMINAL_EVENTS

MAX_ATTEMPTS = 3
COOLDOWN_MINUTES = 60
REFRESH_DAYS = 14


def publications_since(pubs: DataFrame, period: str, now: datetime,
                       on: str = "publicatie_datum") -> DataFrame:
    """Publications of the last week, today or the last month, by a constant lower bound."""
    return pubs.filter(F.col(on) >= F.lit(period_start(period, now).date()))


def discovery_dedup(found: DataFrame, courts: list[str] = COURTS) -> DataFrame:
    """First-seen hit per id: courts in search order, then position within the court."""
    rank = F.array_position(F.array(*[F.lit(c) for c in courts]), F.col("court"))
    first = F.min(F.struct(rank.alias("rank"), "position", "court", "description"))
    return (found.filter(rank > 0).groupBy("kenmerk").agg(first.alias("f"))
            .select("kenmerk", "f.court", "f.description"))


def attempt_summary(raw: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """Attempts per id.  The log is aggregated before the semi-join: map-side combining leaves
    one row per id and task, so a hot id costs nothing in the join."""
    summary = raw.groupBy("kenmerk").agg(
        F.max("scraped_at").alias("last_attempt"),
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("status") == "ok").alias("successes"),
        F.count_if(F.col("status") == "purged").alias("purged"))
    if candidates is None:
        return summary
    return summary.join(candidates.select("kenmerk"), "kenmerk", "left_semi")


def discovery_eligible(candidates: DataFrame, raw: DataFrame, now: datetime,
                       max_attempts: int = MAX_ATTEMPTS,
                       cooldown: timedelta = timedelta(minutes=COOLDOWN_MINUTES)) -> DataFrame:
    """Candidates (kenmerk, court) never scraped successfully and due for another attempt."""
    seen = attempt_summary(raw)
    joined = candidates.select("kenmerk", "court").join(seen, "kenmerk", "left")
    return joined.filter(_due(now, max_attempts, cooldown)).select("kenmerk", "court")


def _due(now: datetime, max_attempts: int, cooldown: timedelta) -> Column:
    """Never tried, or without a good or final answer and neither too often nor just now."""
    again = ((F.col("purged") == 0) & (F.col("successes") == 0)
             & (F.col("attempts") < max_attempts)
             & (F.col("last_attempt") <= F.lit(now - cooldown)))
    return F.col("attempts").isNull() | again


def refresh_candidates(raw: DataFrame, pubs: DataFrame, now: datetime,
                       days: int = REFRESH_DAYS, limit: int | None = None,
                       on: str = "kenmerk") -> DataFrame:
    """Open company and sole-trader cases whose last good scrape is old: all of them, or the
    ``limit`` oldest.

    ``on`` names the publication column holding the attempt-log id.
    """
    per_case = attempt_state(raw.filter(F.col("status").isin("ok", "purged")))
    open_cases = per_case.filter(refreshed_kind() & (F.col("purged") == 0)
                                 & (F.col("last_ok") < F.lit(now - timedelta(days=days))))
    closed = (pubs.filter(F.col("event_type").isin(TERMINAL_EVENTS))
              .select(F.col(on).alias("kenmerk")).distinct())
    stale = open_cases.join(closed, "kenmerk", "left_anti").select("kenmerk", "last_ok")
    return stale if limit is None else stale.orderBy("last_ok", "kenmerk").limit(limit)


def task_union(discovery: DataFrame, refresh: DataFrame) -> DataFrame:
    """Discovery tasks, then refresh tasks not among them (after the refresh limit)."""
    extra = refresh.select("kenmerk").join(discovery.select("kenmerk"), "kenmerk", "left_anti")
    return discovery.select("kenmerk", "court").unionByName(
        extra.withColumn("court", F.lit("")))


def fetch_worklist(raw: DataFrame, pubs: DataFrame, candidates: DataFrame, now: datetime,
                   max_attempts: int = MAX_ATTEMPTS,
                   cooldown: timedelta = timedelta(minutes=COOLDOWN_MINUTES),
                   days: int = REFRESH_DAYS, limit: int | None = None) -> DataFrame:
    """(kenmerk, court) of every case to fetch now."""
    return due_cases(attempt_state(raw), pubs, candidates, now, max_attempts, cooldown, days,
                     limit)


def due_cases(state: DataFrame, pubs: DataFrame, candidates: DataFrame, now: datetime,
              max_attempts: int = MAX_ATTEMPTS,
              cooldown: timedelta = timedelta(minutes=COOLDOWN_MINUTES),
              days: int = REFRESH_DAYS, limit: int | None = None) -> DataFrame:
    """(kenmerk, court) of every case to fetch now, by a state of attempts (``attempt_state`` of
    the log, or ``attempts.read_state``), which is read once.

    No case is both new and old: a new one has no good attempt, one to refresh has.  So candidates,
    state and closed cases meet in one chain of joins, and each row decides for itself.  With a
    ``limit`` the oldest cases to refresh are taken first, in a second reading.
    """
    found = candidates.groupBy("kenmerk").agg(F.collect_list("court").alias("courts"))
    closed = (pubs.filter(F.col("event_type").isin(TERMINAL_EVENTS)).select("kenmerk").distinct()
              .withColumn("closed", F.lit(True)))
    old = (refreshed_kind() & (F.col("purged") == 0)
           & (F.col("last_ok") < F.lit(now - timedelta(days=days))))
    known = state.withColumn("old", F.coalesce(old, F.lit(False)))
    cases = found.join(known, "kenmerk", "full").join(closed, "kenmerk", "left")
    new = F.col("courts").isNotNull() & F.coalesce(_due(now, max_attempts, cooldown), F.lit(False))
    stale = F.coalesce(F.col("old"), F.lit(False)) & F.col("closed").isNull()
    if limit is None:
        courts = F.when(new, F.col("courts")).when(stale, F.array(F.lit("")))
        return cases.select("kenmerk", F.explode(courts).alias("court"))
    oldest = cases.filter(stale).orderBy("last_ok", "kenmerk").limit(limit)
    return cases.filter(new).select("kenmerk", F.explode("courts").alias("court")).union(
        oldest.select("kenmerk", F.lit("").alias("court")))


def _succeeded(raw: DataFrame) -> DataFrame:
    return raw.filter("status = 'ok'").select("kenmerk").distinct()


def legacy_pending(legacy: DataFrame, raw: DataFrame, queued: DataFrame) -> DataFrame:
    """Legacy ids without a good attempt that are not queued yet."""
    ids = legacy.select("kenmerk").filter("kenmerk != ''").distinct()
    return (ids.join(_succeeded(raw), "kenmerk", "left_anti")
            .join(queued.select("kenmerk").distinct(), "kenmerk", "left_anti"))


def pending_probe(listing: DataFrame, probes: DataFrame, cases: DataFrame,
                  limit: int | None = None) -> DataFrame:
    """Case numbers neither probed nor known, newest case year first."""
    numbers = listing.select("insolventienummer").filter("insolventienummer != ''").distinct()
    pending = numbers
    for known in (probes, cases):
        pending = pending.join(known.select("insolventienummer").distinct(),
                               "insolventienummer", "left_anti")
    ordered = pending.withColumn("case_year", case_year(F.col("insolventienummer"))).orderBy(
        F.col("case_year").desc(), "insolventienummer")
    return ordered if limit is None else ordered.limit(limit)


def first_last_reports(documents: DataFrame) -> DataFrame:
    """Earliest and latest narrative and latest financial report per case having both kinds.

    Undated reports do not count; equal dates are decided by id.
    """
    live = latest_per_key(documents, DOCUMENTS.key, DOCUMENTS.version,
                          ["document_date", "document_type"])
    by_date = F.struct("document_date", "document_kenmerk")
    dated = F.col("document_date").isNotNull()
    narrative = F.when(dated & (F.col("document_type") == "Verslag"), by_date)
    financial = F.when(dated & (F.col("document_type") == "Financieel verslag"), by_date)
    picked = live.groupBy("kenmerk").agg(
        F.min(narrative).alias("n0"), F.max(narrative).alias("n1"),
        F.max(financial).alias("f1"))
    return picked.filter("n0 is not null and f1 is not null").select(
        "kenmerk", F.col("n0.document_kenmerk").alias("first_nar"),
        F.col("n1.document_kenmerk").alias("last_nar"),
        F.col("f1.document_kenmerk").alias("last_fin"))


def extraction_worklist(documents: DataFrame, cases: DataFrame, done: DataFrame | None = None,
                        limit: int | None = None) -> DataFrame:
    """Cases with both report kinds, their company details where known, minus ``done``."""
    company = latest_per_key(
        cases.filter("type = 'company'").select("kenmerk", "insolventienummer", "kvk_nummer",
                                                "debtor_name", "scraped_at"),
        ["kenmerk"], "scraped_at").drop("scraped_at")
    work = first_last_reports(documents).join(company, "kenmerk", "left")
    if done is not None:
        work = work.join(done.select("kenmerk").distinct(), "kenmerk", "left_anti")
    return work if limit is None else work.orderBy("kenmerk").limit(limit)

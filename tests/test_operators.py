import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from estatelens.operators import backfill, registry, worklists
from estatelens.operators.latest import latest_per_key
from estatelens.schemas import CASES
from estatelens.sources import rawlog, tables

NOW = datetime(2024, 6, 1)
OLD, RECENT = NOW - timedelta(days=30), NOW - timedelta(minutes=5)
LOG = "kenmerk string, scraped_at timestamp, status string, entity_type string, record string"


def ids(df, column="kenmerk"):
    return sorted(r[column] for r in df.collect())


def test_latest_breaks_ties_the_same_way(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, None)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, v int, w string")
        got = latest_per_key(df, ["k"], "v").orderBy("k").collect()
        assert [tuple(r) for r in got] == [("a", 2, "z"), ("b", 1, None)]


def test_latest_limits_a_hot_key_before_the_shuffle(spark):
    df = spark.range(3000).select((F.col("id") % 3 * 0).alias("k"), F.col("id").alias("v"))
    out = latest_per_key(df, ["k"], "v")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert [tuple(r) for r in out.collect()] == [(0, 2999)]


def test_discovery_rules(spark):
    log = spark.createDataFrame(
        [("ok", OLD, "ok", "company", ""), ("gone", OLD, "purged", "", "")]
        + [("tired", OLD, "fetch_failed", "", "")] * 3
        + [("cooling", RECENT, "fetch_failed", "", ""), ("due", OLD, "parse_failed", "", ""),
           ("other", OLD, "fetch_failed", "", "")], LOG)
    candidates = spark.createDataFrame(
        [(k, "c") for k in ("ok", "gone", "tired", "cooling", "due", "new")],
        "kenmerk string, court string")
    assert ids(worklists.discovery_eligible(candidates, log, NOW)) == ["due", "new"]
    assert "other" not in ids(worklists.attempt_summary(log, candidates))


def test_refresh_rules_and_union_after_limit(spark):
    log = spark.createDataFrame(
        [("open", OLD, "ok", "company", ""), ("older", OLD - timedelta(days=9), "ok", "eenmanszaak", ""),
         ("ended", OLD, "ok", "company", ""), ("person", OLD, "ok", "person", ""),
         ("fresh", RECENT, "ok", "company", ""), ("fresh", OLD, "ok", "company", ""),
         ("dropped", OLD, "ok", "company", ""), ("dropped", OLD, "purged", "", ""),
         ("became", OLD - timedelta(days=1), "ok", "person", ""), ("became", OLD, "ok", "company", ""),
         ("left", OLD - timedelta(days=1), "ok", "company", ""), ("left", OLD, "ok", "person", "")], LOG)
    pubs = spark.createDataFrame([("ended", "einde"), ("open", "zitting")],
                                 "kenmerk string, event_type string")
    got = worklists.refresh_candidates(log, pubs, NOW)
    assert sorted(r["kenmerk"] for r in got.collect()) == ["became", "older", "open"]
    discovery = spark.createDataFrame([("older", "c")], "kenmerk string, court string")
    limited = worklists.refresh_candidates(log, pubs, NOW, limit=2)
    union = worklists.task_union(discovery, limited).collect()
    assert sorted(map(tuple, union)) == [("became", ""), ("older", "c")]


def test_anti_joins_survive_nulls(spark):
    listing = spark.createDataFrame([("F.01/20/1",), ("F.01/99/2",), ("F.01/21/3",), ("",)],
                                    "insolventienummer string")
    known = spark.createDataFrame([(None,), ("F.01/20/1",)], "insolventienummer string")
    empty = known.filter("false")
    got = worklists.pending_probe(listing, known, empty).collect()
    assert [tuple(r) for r in got] == [("F.01/21/3", 2021), ("F.01/99/2", 1999)]


def test_first_and_last_reports(spark):
    day = "1970-01-0"
    docs = spark.createDataFrame(
        [("a", "n1", day + "2", "Verslag"), ("a", "n2", day + "2", "Verslag"),
         ("a", "n0", None, "Verslag"), ("a", "f1", day + "1", "Financieel verslag"),
         ("a", "t9", day + "9", "Tussentijds financieel verslag"),
         ("b", "n1", day + "1", "Verslag"), ("c", "f1", day + "1", "Financieel verslag"),
         ("d", "n1", day + "1", "Verslag"), ("d", "f1", None, "Financieel verslag")],
        "kenmerk string, document_kenmerk string, d string, document_type string").select(
        "kenmerk", "document_kenmerk", F.to_date("d").alias("document_date"), "document_type",
        F.lit(NOW).alias("scraped_at"))
    got = worklists.first_last_reports(docs).collect()
    assert [tuple(r) for r in got] == [("a", "n1", "n2", "f1")]


def test_snapshot_keeps_rows_with_either_side(spark):
    cases = spark.createDataFrame(
        [("k1", "company", "A", NOW), ("k2", "company", "B", NOW), ("k3", "eenmanszaak", "C", NOW),
         ("k4", "person", "D", NOW), ("k5", "company", None, NOW), ("k6", "company", "", NOW),
         ("k7", "company", "E", NOW)], "kenmerk string, type string, kvk_nummer string, "
        "scraped_at timestamp").withColumn("court", F.lit("x"))
    codes = spark.createDataFrame(
        [("A", "2", "two", False), ("A", "1", "one", True), ("A", "1", "one", True)],
        "kvk_nummer string, sbi_code string, sbi_description string, is_main_activity boolean")
    business = spark.createDataFrame(
        [("A", "aaa", ["x"], "BV"), ("B", "éé", ["bytes"], "NV"), ("B", "abc", ["chars"], "BV")],
        "kvk_nummer string, activiteit_omschrijving string, huidige_handelsnamen array<string>, "
        "rechtsvorm_omschrijving string")
    existing = spark.createDataFrame([("E",)], "kvk_nummer string")
    got = {r["kvk_nummer"]: r for r in registry.registry_snapshot(
        cases, codes, business, existing).collect()}
    assert sorted(got) == ["A", "B"]
    assert (got["A"]["sbi_codes"], got["A"]["sbi_descriptions"], got["A"]["sbi_hoofd"]) == (
        ["1", "1", "2"], ["one", "one", "two"], "1")
    assert (got["B"]["handelsnamen"], got["B"]["rechtsvorm"], got["B"]["sbi_codes"]) == (
        ["bytes"], "BV", [])


def test_court_audit(spark):
    samples = spark.createDataFrame([("alk", "alk.09.7.F"), ("xyz", "xyz.09.1.F"),
                                     ("rot", "rot.10.5.F")], "abbr string, case_key string")
    observed = spark.createDataFrame(
        [("F.14/09/7", "alk.09.7.F.V.01"), ("F.01/09/7", "alk.x"), ("F.03/10/5", "rot_x"),
         ("F.10/10/5", "ams_x")], "insolventienummer string, verslag_kenmerk string")
    got = {r["abbr"]: (r["mapped"], r["actual"], r["verdict"])
           for r in backfill.court_map_audit(samples, observed).collect()}
    assert got == {"alk": (14, 14, "OK"), "xyz": (None, None, "OK"), "rot": (10, 3, "MISMATCH")}


def test_batches_lose_no_row_at_a_shared_time(spark):
    log = spark.createDataFrame([(k, OLD, "ok", "", "r") for k in "abcde"], LOG)
    seen, point = [], (OLD - timedelta(days=1), "")
    for _ in range(3):
        batch = rawlog.incremental_batch(log, point, 2)
        seen += [r["kenmerk"] for r in batch.collect()]
        point = tuple(rawlog.next_checkpoint(batch).select("scraped_at", "kenmerk").collect()[0])
    assert seen == list("abcde")


def test_committed_batches_never_pass_rows_unseen(spark, tmp_path):
    """Rows with an early time arrive between the steps; a step is cut short before its commit."""
    folder, start = str(tmp_path / "batches"), (OLD - timedelta(days=1), "")

    def log(names):
        return spark.createDataFrame([(k, OLD, "ok", "", "r") for k in names], LOG)

    def take(names, step, limit=2):
        return [r.kenmerk for r in rawlog.take_batch(log(names), folder, step, start, limit)
                .orderBy("kenmerk").collect()]

    assert take("abde", 0) == ["a", "b"]
    assert take("aabcde", 0) == ["a", "b"]  # committed: read as written
    with pytest.raises(ValueError):
        take("abcde", 2)
    # rows without a commit: the step is made anew and sees what has come
    rawlog.incremental_batch(log("de"), start).write.parquet(f"{folder}/rows/step=1")
    os.makedirs(f"{folder}/commits/step=1")
    assert take("abcde", 1) == ["c", "d"]
    assert take("abcde", 2, None) == ["e"] and take("abcde", 3) == []
    assert rawlog.checkpoint_of(spark, folder, 3) == rawlog.checkpoint_of(spark, folder, 2) == (
        OLD, "e")
    assert rawlog.checkpoint_of(spark, folder, 4) is None


def test_bucketed_table_is_read_in_place(spark, tmp_path):
    """A hot case with most of the versions; two writes; no exchange when reading."""
    rows = spark.createDataFrame(
        [(f"k{i % 9 if i % 3 else 0}", "c", "company", NOW - timedelta(hours=(i * 7) % 200), i)
         for i in range(300)],
        "kenmerk string, court string, type string, scraped_at timestamp, n int")
    for part in (0, 1):
        tables.write_bucketed(rows.where(F.col("n") % 2 == part), "bucketed_cases",
                              str(tmp_path / "cases"), CASES, 4)
    live = tables.live_table(spark, "bucketed_cases", CASES, ["n"])
    assert sorted(live.collect()) == sorted(
        latest_per_key(rows, CASES.key, CASES.version, ["n"]).collect())
    assert "Exchange" not in live._jdf.queryExecution().executedPlan().toString()
    spark.sql("drop table bucketed_cases")


def test_month_layout_prunes(spark, tmp_path):
    rows = spark.createDataFrame(
        [(f"k{i}", "c", "company", datetime(2024, 1 + i % 3, 5), "ok", "r") for i in range(30)],
        "kenmerk string, court string, type string, scraped_at timestamp, status string, "
        "record string")
    path = str(tmp_path / "cases")
    tables.write_table(rows, path, CASES)
    back = tables.read_table(spark, path)
    late = rawlog.raw_ok(back, datetime(2024, 3, 1))
    assert late.count() == 10 and tables.live_rows(spark, path, CASES).count() == 30
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "scraped_month" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "status" in plan.split("PushedFilters")[1].split("]")[0]


def test_attempt_state_adds_up_and_is_scanned_once(spark, tmp_path):
    from estatelens.operators import attempts

    log = spark.createDataFrame(
        [("a", datetime(2024, 1, 1), "ok", "company"), ("a", datetime(2024, 2, 1), "ok", "person"),
         ("b", datetime(2024, 1, 1), "ok", "person"), ("b", datetime(2024, 3, 1), "ok", "company"),
         ("c", datetime(2024, 1, 1), "fetch_failed", ""), ("d", datetime(2024, 1, 1), "ok", None),
         ("d", datetime(2024, 1, 2), "purged", ""), ("e", datetime(2024, 1, 1), "ok", "company"),
         (None, datetime(2024, 1, 1), "ok", "company")],
        "kenmerk string, scraped_at timestamp, status string, entity_type string")
    log.write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    whole = sorted(map(repr, attempts.attempt_state(log).collect()))
    path = str(tmp_path / "state")
    for month in ("2024-02", "2024-01", "2024-03", "2024-01"):  # any order, one part twice
        attempts.add_attempts(log.filter(F.date_format("scraped_at", "yyyy-MM") == month), path,
                              month)
    kept = attempts.read_state(spark, path)
    assert sorted(map(repr, kept.collect())) == whole
    attempts.compact_state(spark, path, str(tmp_path / "compact"))
    assert sorted(map(repr, attempts.read_state(spark, str(tmp_path / "compact")).collect())) \
        == whole

    pubs = spark.createDataFrame([("e", "einde"), ("e", "zitting")], "kenmerk string, event_type string")
    candidates = spark.createDataFrame([("c", "C1"), ("c", "C2"), ("n", "C1"), ("b", "C1")],
                                       "kenmerk string, court string")
    pubs = pubs.withColumn("event_type", F.when(F.col("event_type") == "einde",
                                                F.lit(worklists.TERMINAL_EVENTS[0]))
                           .otherwise(F.col("event_type")))
    now = datetime(2024, 6, 1)
    want = [("b", ""), ("c", "C1"), ("c", "C2"), ("n", "C1"), (None, "")]
    direct = worklists.fetch_worklist(log, pubs, candidates, now)
    for got in (direct, worklists.due_cases(kept, pubs, candidates, now)):
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    limited = worklists.fetch_worklist(log, pubs, candidates, now, limit=1)
    assert sorted(map(tuple, limited.collect()), key=str) == sorted(
        [(None, ""), *want[1:4]], key=str)
    plan = direct._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count(f"{tmp_path.name}/log") == 1

"""The mined-report table, key bitmaps and the absence of report text in shuffles."""

import re
from datetime import datetime

from pyspark.sql import functions as F

from estatelens.operators.keyset import flag_known, probably_in
from estatelens.plans.extraction import extract_company, extract_mined
from estatelens.plans.mined import add_reports, mined_reports, report_keys, unseen_texts
from tests.test_answers import NARRATIVE

WORK = ("kenmerk string, first_nar string, last_nar string, last_fin string, "
        "insolventienummer string, kvk_nummer string, debtor_name string")


def _exchanged(df):
    """Column names that shuffles of the plan carry."""
    plan = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    blocks = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan, re.S)
    return {re.sub(r"#\d+L?$", "", c.strip()) for b in blocks for c in b.split(",")}


def test_key_bitmap_never_misses_a_key(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"),
                                    (F.col("id") % 2).alias("n"))
    rows = spark.range(6000).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    found = {r.id: (r.even, r.odd) for r in flag_known(
        rows, keys, ["k"], {"even": F.col("n") == 0, "odd": F.col("n") == 1}).collect()}
    assert all(found[i][i % 2] for i in range(3000))
    wrong = sum(found[i][0] or found[i][1] for i in range(3000, 6000)) \
        + sum(found[i][1 - i % 2] for i in range(3000))
    assert wrong < 60  # one in a hundred
    assert probably_in(rows, keys.limit(0), ["k"]).count() == 0
    assert probably_in(rows, spark.createDataFrame([(None,)], "k string"), ["k"]).count() <= 5


def test_only_unseen_texts_are_mined(spark, tmp_path):
    path = str(tmp_path / "mined")
    def texts(*rows):
        return spark.createDataFrame(rows, "document_kenmerk string, text string")

    assert mined_reports(spark, path) is None
    add_reports(texts(("n", "2. Personeel"), ("f", None)), path, datetime(2026, 1, 1))
    now = texts(("n", NARRATIVE), ("f", None), ("g", ""))
    mined = mined_reports(spark, path)
    assert {r.document_kenmerk for r in unseen_texts(now, mined).collect()} == {"n", "g"}
    add_reports(now, path, datetime(2026, 1, 2))
    add_reports(now, path, datetime(2026, 1, 3))
    mined = mined_reports(spark, path)
    assert mined.count() == 4 and mined.filter("mined_at > '2026-01-02'").count() == 0

    work = spark.createDataFrame([("K1", "n", "n", "f", "F.1", "1", "D")], WORK)
    newer = extract_mined(work, mined, report_keys(now), salt="s").first()
    direct = extract_company(work, now, salt="s").first()
    assert newer == direct and newer["personeel_ttv"] == 12
    # an older text that comes back counts again, though it was mined first
    older = extract_mined(work, mined, report_keys(texts(("n", "2. Personeel"), ("f", ""))),
                          salt="s").first()
    assert older["personeel_ttv"] is None


def test_no_report_text_is_shuffled(spark, tmp_path):
    spark.createDataFrame([("n", NARRATIVE, "d1")], "document_kenmerk string, text string, "
                          "text_digest string").write.parquet(str(tmp_path / "texts"))
    texts = spark.read.parquet(str(tmp_path / "texts"))
    work = spark.createDataFrame([("K1", "n", "n", "f", "F.1", "1", "D")], WORK)
    path = str(tmp_path / "mined")
    add_reports(texts, path, datetime(2026, 1, 1))
    mined = mined_reports(spark, path)
    for plan in (extract_company(work, texts, salt="s"), unseen_texts(texts, mined)):
        assert not {"text", "cleaned", "_found"} & _exchanged(plan)
    # keys alone are read where a digest is stored
    scans = extract_mined(work, mined, report_keys(texts), salt="s")
    assert "text:string" not in scans._jdf.queryExecution().executedPlan().toString()

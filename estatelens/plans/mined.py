"""Mined reports kept between runs, keyed by report id and a digest of the text.

A run mines only texts whose (id, digest) the table does not hold.  Keys decide that, not texts:
ids and digests are joined, and a bitmap of the new ones, of a fixed size, picks the texts where
they lie.  A report whose text changed is a new key; its old row stays and counts again if the old
text comes back.  Rows are equal whenever id and digest are, so a row written twice does no harm.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelens.operators.keyset import probably_in
from estatelens.plans.extraction import mine_texts
from estatelens.schemas import MINED
from estatelens.sources.tables import read_table, stamped, write_table

KEY = list(MINED.key)


def with_digest(texts: DataFrame) -> DataFrame:
    """(document_kenmerk, text) with ``text_digest``; a table that already has the column keeps
    it, and its texts are then read only where they are mined.  A NULL text counts as empty."""
    if "text_digest" in texts.columns:
        return texts.select(*KEY, "text")
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return texts.select("document_kenmerk", digest.alias("text_digest"), "text")


def report_keys(texts: DataFrame) -> DataFrame:
    """(document_kenmerk, text_digest) of the texts that count now."""
    return with_digest(texts).select(*KEY).distinct()


def mined_reports(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of the table, or None before the first run."""
    try:
        return read_table(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def unseen_texts(texts: DataFrame, mined: DataFrame | None) -> DataFrame:
    """The texts to mine: all new ones and, by chance, very few of those mined before."""
    keyed = with_digest(texts)
    if mined is None:
        return keyed
    new = report_keys(texts).join(mined.select(*KEY), KEY, "left_anti")
    return probably_in(keyed, new, KEY)


def add_reports(texts: DataFrame, path: str, at: datetime) -> None:
    """Mines the texts that the table at ``path`` lacks and appends them, stamped ``at``.

    The append is one commit: after a failure the table is as before, and running again mines the
    same texts.
    """
    new = unseen_texts(texts, mined_reports(texts.sparkSession, path))
    write_table(stamped(mine_texts(new), MINED, at), path, MINED)

"""Stages that keep all columns, whatever the columns are called."""

from estatelens.llm.jaccard import drop_near_copies
from estatelens.llm.mixing import MixParams, mix_documents, mixed_rows
from estatelens.llm.personal import redact_personal
from estatelens.llm.toxicity import drop_toxic

NAMES = ["_found", "_email", "_ip", "_card", "_phone", "_added", "_tokens", "_leaf", "_epoch",
         "_hash", "_bucket", "_whole", "_rest", "_last", "_before", "_upto", "_text", "_toxicity",
         "_kept", "_rows", "_keep", "others", "score", "kept", "rows", "keep", "key", "class",
         "with.dot"]


def _docs(spark):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(1, text, "en", "a"), (2, text, "en", "a"), (3, "mail a@b.cc now", "de", "b"),
            (4, None, None, None), (None, "lone text here", "en", "b")]
    return spark.createDataFrame(
        [(*r, *[f"{n}{i}" for n in NAMES]) for i, r in enumerate(rows)],
        "doc_id long, text string, lang string, source string, "
        + ", ".join(f"`{n}` string" for n in NAMES))


def _kept(before, after, names=tuple(NAMES)):
    """Rows left, whose further columns are those they came with."""
    assert after.columns == before.columns
    at = [before.columns.index(n) for n in names]
    came = {r[0]: [r[i] for i in at] for r in before.collect()}
    rows = after.collect()
    assert all([r[i] for i in at] == came[r[0]] for r in rows)
    return sorted((r[0] for r in rows), key=str)


def test_stages_keep_clashing_columns(spark):
    docs = _docs(spark)
    labels = spark.createDataFrame([(1, 0), (3, 0)], "doc_id long, toxic int")
    assert _kept(docs, drop_toxic(docs, labels)) == [1, 2, 3, 4, None]
    assert _kept(docs, drop_near_copies(docs)) == [1, 3, 4, None]
    redacted = redact_personal(docs)
    assert _kept(docs, redacted) == [1, 2, 3, 4, None]
    assert "mail <EMAIL> now" in [r.text for r in redacted.collect()]
    whole = MixParams(epochs=1, share=1.0)
    assert _kept(docs, mixed_rows(docs, whole)) == [1, 2, 3, 4, None]
    named = mix_documents(docs, whole)
    assert {r._epoch for r in named.collect()} == {0}
    assert sorted(named.columns) == sorted(docs.columns)


def test_a_table_of_two_columns(spark):
    docs = _docs(spark).select("doc_id", "text")
    assert drop_near_copies(docs).columns == redact_personal(docs).columns == ["doc_id", "text"]
    assert redact_personal(docs).count() == 5

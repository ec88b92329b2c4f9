"""URL filters, toxicity, mixing and chats against plain versions."""

import re
import zlib

import numpy as np
import pytest

from estatelens.llm.chat import format_chats
from estatelens.llm.mixing import MixParams, fill_by_weight, leaf_budgets, mix_documents
from estatelens.llm.toxicity import (Ftrl, ToxicityParams, drop_toxic, fit_toxicity,
                                     toxicity_scores)
from estatelens.llm.urls import RULES, TermCounter, judge_urls

# ------------------------------------------------------------------------------------- urls

URLS = [None, "", "no scheme", "://", "http://", "HTTP://EXAMPLE.ORG/es/x?y#z", "http://Éx.org/a",
        "http://example.org", "http://example.org?q", "http://a.example.org/en/12", "http://org/",
        "http://xexample.org/es/", "x://a.com/de/1#x", "x://com/fr/", "x://a.com/fr", "a://b://c/d",
        "http://adult-x.net/", "http://adultery.net/", "http://a.net/casino/free", "x://a.net/porn",
        "http://a.net/casino/casino", "http://free.net/win/bet", "http://é" + "x" * 9000 + ".org/"]


def plain_url(url):
    rest = (url or "").partition("://")[2]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(r, v) for r, v in RULES for name, _, start in [r.partition("/")]
            if (host == name or host.endswith("." + name)) and path.startswith("/" + start)]
    return host, path, max(fits, key=lambda x: len(x[0]), default=(None, None))


def test_urls(spark):
    rows = [(i, u, "page", "h") for i, u in enumerate(URLS)] + [(3, URLS[9], "x", "h")] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = judge_urls(df).collect()
    assert len(got) == len(rows)
    for r in got[:len(URLS)]:
        host, path, (rule, verdict) = plain_url(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule), URLS[r.page_id]
        assert verdict is None or r.verdict == verdict
    judged = {URLS[r.page_id]: r.verdict for r in got[:len(URLS)]}
    assert judged["http://adult-x.net/"] == "block" == judged["http://a.net/casino/free"]
    assert judged["http://adultery.net/"] == "allow" == judged["http://a.net/casino/casino"]
    assert judged["http://free.net/win/bet"] == "block" and judged[None] == "allow"
    assert judge_urls(df.limit(0)).count() == 0


def test_terms_overlap_and_stand_alone():
    counter = TermCounter(["ab", "abc", "bc"])
    assert counter.terms("ab abc-bc xab bcd") == {"ab", "abc", "bc"}
    assert counter.terms("xabx") == set() and TermCounter([]).terms("ab") == set()


# --------------------------------------------------------------------------------- toxicity


def _labelled(spark, n=600):
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = list(rng.choice(words, 60))
        toxic = i % 4 == 0
        if toxic:
            text[int(rng.integers(50))] = "Vile"
            text[int(rng.integers(50))] = "nastyness" if i % 8 else "nastyfoo"
        docs.append((i, " ".join(text), "en"))
        labels.append((i, int(toxic), 1))
    docs += [(n, None, "x"), (n + 1, "", "x"), (None, "Vile nastyness", "x"), (3, docs[3][1], "en"),
             (n + 2, "vile " * 30000, "x")]
    labels += [(5, None, 0), (6, 7, 0), (None, 1, 0), (8, 0, 0), (999_999, 1, 0)]
    return (spark.createDataFrame(docs, "doc_id long, text string, score string"),
            spark.createDataFrame(labels, "doc_id long, toxic int, text int"))


PARAMS = ToxicityParams(bits=14, learner_rows=300, l1=2.0)


def test_held_out_accuracy_and_edges(spark):
    docs, labels = _labelled(spark)
    rows = toxicity_scores(docs, labels, PARAMS).collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out and r.doc_id < 600]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
               for r in rows if r.doc_id is not None)
    right = sum(r.predicted == (r.doc_id % 4 == 0) for r in held)
    assert right >= 0.95 * len(held)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[600].score == by_id[601].score < 0.5
    assert not by_id[None].held_out and by_id[None].predicted == 1 and by_id[602].predicted == 1
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_held_out_labels_change_nothing(spark):
    docs, labels = _labelled(spark, 200)
    one = fit_toxicity(docs.select("doc_id", "text"), labels, PARAMS)
    turned = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) as toxic")
    assert (one == fit_toxicity(docs.select("doc_id", "text"), turned, PARAMS)).all()


def test_weights_are_sparse():
    learner = Ftrl(ToxicityParams(bits=8))
    for i in range(400):
        learner.learn(np.array([3 if i % 2 else 5, 10 + i % 200, 256]), i % 2)
    weights = learner.weights(slice(None))
    assert weights[3] > 0 > weights[5] and np.count_nonzero(weights[10:210]) == 0


def test_dropping_toxic_documents(spark):
    docs, labels = _labelled(spark)
    kept = drop_toxic(docs, labels, PARAMS)
    scores = toxicity_scores(docs, labels, PARAMS)
    assert kept.columns == docs.columns
    assert kept.count() == scores.where("predicted = 0").count()
    none = labels.limit(0)
    assert drop_toxic(docs, none, PARAMS).count() == docs.count()
    assert toxicity_scores(docs.limit(0), labels, PARAMS).count() == 0


# ----------------------------------------------------------------------------------- mixing


def test_shortage_goes_to_siblings_before_ancestors():
    supply = {("a", "x", "s1"): 10, ("a", "x", "s2"): 1000, ("a", "y", "s3"): 1000,
              ("b", "x", "s4"): 1000}
    got = leaf_budgets(supply, 400, MixParams())
    assert got == {("a", "x", "s1"): 10, ("a", "x", "s2"): 90, ("a", "y", "s3"): 100,
                   ("b", "x", "s4"): 200}
    supply[("a", "x", "s2")] = 20
    assert leaf_budgets(supply, 400, MixParams())[("a", "y", "s3")] == 170
    weights = {"domain": {"b": 0.0}}
    got = leaf_budgets(supply, 4000, MixParams(weights=weights, epochs=2))
    assert got[("b", "x", "s4")] == 0 and got[("a", "x", "s1")] == 20
    assert fill_by_weight(10, {"a": 3, "b": 100}, {"a": 1, "b": 1}) == {"a": 3, "b": 7}


@pytest.mark.parametrize("epochs,share", [(1, 0.5), (3, 1.4), (1, 2.0)])
def test_mixture_is_a_prefix_of_each_epoch(spark, epochs, share):
    rng = np.random.default_rng(1)
    rows = [(i, "w " * int(rng.integers(0, 30)), ["en", "de", None][int(rng.integers(3))],
             "hot" if i % 3 else f"s{i % 7}") for i in range(1500)]
    rows += [(4, rows[4][1], rows[4][2], rows[4][3]), (None, None, "zz", None),
             (None, "", "zz", None), (7777, "w " * 50000, "en", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string") \
        .selectExpr("*", "1 as tokens", "2 as whole")
    params = MixParams(domains={"hot": "crawl"}, weights={"domain": {"crawl": 2.0}},
                       epochs=epochs, share=share, bucket_rows=20)
    got = mix_documents(docs, params)
    assert set(docs.columns) < set(got.columns)
    names = lambda r: ("crawl" if r[3] == "hot" else "other", r[2] or "", r[3] or "")
    supply = {}
    for r in rows:
        supply[names(r)] = supply.get(names(r), 0) + len((r[1] or "").split())
    budgets = leaf_budgets(supply, sum(supply.values()) * share, params)
    taken, rest = {}, {}
    for r in got.collect():
        leaf = tuple(r._leaf)
        taken[leaf] = taken.get(leaf, 0) + r._tokens
        rest.setdefault(leaf, []).append(r)
    for leaf, n in supply.items():
        if not n:
            assert len(rest[leaf]) == 2  # nothing to count: once each
            continue
        assert taken.get(leaf, 0) <= budgets[leaf]
        whole = min(budgets[leaf] // n, epochs)
        size = sum(names(r) == leaf for r in rows)
        for epoch in range(whole):
            assert sum(r._epoch == epoch for r in rest[leaf]) == size
        longest = max(len((r[1] or "").split()) for r in rows if names(r) == leaf)
        if whole < epochs:
            assert taken.get(leaf, 0) > budgets[leaf] - longest - 1
    again = mix_documents(docs.repartition(7), params)
    assert sorted(map(repr, got.select("doc_id", "_epoch").collect())) == sorted(
        map(repr, again.select("doc_id", "_epoch").collect()))
    assert mix_documents(docs.limit(0), params).count() == 0


# ------------------------------------------------------------------------------------ chats


def plain_chats(rows):
    talks = {}
    for c, turn, role, text in {(c, t, r or "", x or "") for c, t, r, x in rows if c is not None}:
        talks.setdefault(c, []).append(((turn is not None, turn or 0), role, text))
    talks = {c: [(r, x) for _, r, x in sorted(v)] for c, v in talks.items()}
    out = []
    for c, v in talks.items():
        if not any((len(o) > len(v) and o[:len(v)] == v) or (o == v and d < c)
                   for d, o in talks.items()):
            out += [(c, i + 1, len(v), f"<|{r}|>\n{x}\n<|end|>\n") for i, (r, x) in enumerate(v)]
    return sorted(out)


def test_chats_keep_maximal_conversations(spark):
    long = [(i, ("user", "bot")[i % 2], f"turn {i}") for i in range(700)]
    rows = [(1, *t) for t in long] + [(2, *t) for t in long[:300]] + [(3, *t) for t in long[:1]]
    rows += [(4, *t) for t in long] + [(5, 0, "user", "turn 0"), (5, 1, "bot", "other")]
    rows += [(6, t + 100, r, x) for t, r, x in long[:5]] + [(7, None, None, None), (7, 0, "user", "")]
    rows += [(8, 0, "user", "x" * 100_000), (8, 0, "user", "x" * 100_000), (8, 1, "bot", "y")]
    rows += [(9, 0, "user", "x" * 100_000), (None, 0, "user", "lost"), (10, 0, None, None)]
    rows += [(11, -5, "user", "a"), (11, 3, "bot", "b"), (11, 3, "bot", "a"), (12, -9, "user", "a")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows],
                               "conv_id long, turn long, role string, text string, chunk int, "
                               "position int")
    got = sorted(tuple(r) for r in format_chats(df).collect())
    assert got == plain_chats(rows)
    assert format_chats(df.limit(0)).count() == 0

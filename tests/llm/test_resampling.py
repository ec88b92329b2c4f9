"""Importance resampling against a plain version that sorts all rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from estatelens.llm.resampling import ResampleParams, kth_key, resample

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def buckets_of(text, size):
    words = words_of(text)
    return [zlib.crc32(" ".join(words[i:i + n]).encode()) % size
            for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(docs, target, params):
    raw, aim = Counter(), Counter()
    for _, text in docs:
        raw.update(buckets_of(text, params.buckets))
    for text in target:
        aim.update(buckets_of(text, params.buckets))
    s, t, size = sum(raw.values()), sum(aim.values()), params.buckets
    gain = [math.floor(1000 * math.log((aim[b] + 1) * (s + size) / ((raw[b] + 1) * (t + size))))
            for b in range(size)]
    out = []
    for key, text in docs:
        own = buckets_of(text, size)
        name = f"{params.seed}:{'' if key is None else key}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(own), weight, weight + noise, None, len(words_of(text))])
    able = [r for r in out if r[5] >= params.least_words]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    for rank, r in enumerate(able[:params.per_cent * len(able) // 100], 1):
        r[4] = rank
    return Counter(tuple(r[:5]) for r in out)


def _docs():
    rng = random.Random(2)
    vocabulary = [f"Wort{i}" for i in range(80)] + ["Éa", "x" * 70, "y" * 64, "漢字", "7"]
    docs = [(i, " , ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 19, 20, 40, 200]))))
            for i in range(300)]
    copies = [(400 + i, docs[7][1]) for i in range(40)] + [(17, docs[17][1])] * 60
    return docs + copies + [(None, docs[4][1]), (None, docs[4][1]), (900, None), (901, ""),
                            (902, "\x00-- ??")]


@pytest.mark.parametrize("params", [ResampleParams(), ResampleParams(50, 1, buckets=97, pivots=2),
                                    ResampleParams(100, 0), ResampleParams(0)])
def test_equals_plain_version(spark, params):
    docs, target = _docs(), ["Wort1 wort2 WORT3 wort4", None, "x" * 70 + " wort1 7", ""]
    df = spark.createDataFrame([(k, t, 1, "s") for k, t in docs],
                               "doc_id long, text string, score int, row string")
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, weight int")
    got = Counter(tuple(r) for r in resample(df, aim, params).collect())
    assert got == plain(docs, target, params)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a b c " * 20)], "doc_id long, text string")
    assert resample(none, one).count() == 0
    assert resample(one, none).first().weight < 0


def test_every_place_is_found(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(-3, 4), rng.choice([None, 1, 2, 3]), rng.randrange(2), i)
            for i in range(60)]
    df = spark.createDataFrame(rows, "score long, key long, n_features long, row long").cache()
    rows.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2], r[3]))
    for k in (1, 2, 13, 31, 59, 60):
        assert tuple(kth_key(df, k, 4)) == rows[k - 1]

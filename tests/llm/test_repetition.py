"""Repetition rules against counts made on the words themselves."""

import random
import re

from estatelens.llm import repetition
from estatelens.llm.repetition import RepetitionParams, repetition_rules

PARAMS = RepetitionParams()


def plain(text, params=PARAMS):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    out = {"n_words": len(words), "word_chars": sum(map(len, words)),
           "n_symbols": sum(c in "#*$%&|<>" for c in text)}

    def inside(n):
        runs = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        return {i + j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(n)}

    out["n_repeat_words"] = len(inside(3))
    for n in params.run_limits:
        out[f"dup_chars_{n}"] = sum(len(words[i]) for i in inside(n))
    seen, later = set(), []
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            if line in seen:
                later.append(line)
            seen.add(line)
    out["n_dup_lines"] = len(later)
    out["dup_line_chars"] = sum(len(re.sub("[\x20\x09-\x0d]", "", line)) for line in later)
    out["base_failed"] = len(words) < 50 or 100 * out["n_repeat_words"] > 50 * len(words)
    failed = ["lines"] if 100 * out["dup_line_chars"] > params.line_limit * out["word_chars"] \
        else []
    failed += [f"runs_{n}" for n, limit in sorted(params.run_limits.items())
               if 100 * out[f"dup_chars_{n}"] > limit * out["word_chars"]]
    out["failed"], out["kept"] = failed, not out["base_failed"] and not failed
    return out


def _texts():
    rng = random.Random(5)
    made = [" ".join(rng.choice("ab cd Éé ef# 漢字 g$ h".split()) for _ in range(n))
            for n in (0, 1, 2, 3, 5, 49, 60, 300)]
    prose = " ".join(f"word{i}" for i in range(400))
    passage = " ".join(f"again{i}" for i in range(60))
    lines = "\n".join(f"line {i % 30} of them\t" for i in range(60))
    return [None, "", " \n\t ", *made, prose, prose + " " + passage, lines, lines + "\n\n " + lines,
            f"{prose} {passage}\n{passage} {passage}", "same line\n" * 3 + prose, "x" * 5000,
            prose + "\nLine\nline\nLine \nLine", "\r\n".join(["a b"] * 40 + [prose])]


def test_counts_equal_plain_ones(spark, monkeypatch):
    texts = _texts()
    rows = [(i, t, 7, "x") for i, t in enumerate(texts)] + [(3, texts[12], 1, "y"),
                                                           (None, texts[-1], 1, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words long, kept string")
    got = repetition_rules(df).collect()
    want = [{"doc_id": i} | plain(t) for i, t, *_ in rows]
    order = lambda r: (r["doc_id"] is None, r["doc_id"], r["n_words"])
    assert sorted((r.asDict() for r in got), key=order) == sorted(want, key=order)
    assert {r.kept for r in got} == {True, False}
    assert repetition_rules(df.limit(0)).count() == 0


def test_windows_do_not_change_hashes(monkeypatch):
    """Texts far beyond one window: words and lines longer than it, too."""
    import pyarrow as pa

    from estatelens.llm.textbytes import text_slices

    monkeypatch.setattr(repetition, "WINDOW", 40)
    repetition._powers.cache_clear()
    try:
        texts = [*_texts(), "q" * 90 + " " + "q" * 90 + " b " + "q" * 90 + " " + "q" * 90]
        for first, data, offsets in text_slices(pa.array(texts), 1000):
            found = repetition.measure(data, offsets, PARAMS)
            for i in range(len(offsets) - 1):
                want = plain(texts[first + i])
                assert {k: int(v[i]) for k, v in found.items()} == {k: want[k] for k in found}
    finally:
        repetition._powers.cache_clear()


def test_a_common_passage_alone_rejects_nothing(spark):
    prose = [" ".join(f"w{i}x{j}" for j in range(200)) for i in range(4)]
    shared = " ".join(f"shared{j}" for j in range(80))
    df = spark.createDataFrame([(i, f"{p}\n{shared}") for i, p in enumerate(prose)],
                               "doc_id long, text string")
    assert all(r.kept for r in repetition_rules(df).collect())

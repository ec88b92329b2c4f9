"""Quality rules on repetition inside a text, by rolling hashes in numpy.

Words are hashed once; the hash of ``n`` words rolls on to ``n + 1`` by one multiplication and one
addition, so all lengths come from one pass over the word hashes.  Hashes met twice in a text mark
all words of all their places, whose characters are then counted once each, however many runs
overlap there.  Lines are compared by the hash of their bytes.

Hashes have 64 bits: unequal runs of one text count as equal by a chance of about 2**-64 a pair.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm.textbytes import mix, text_slices, word_spans

#: Bytes that are hashed together; a longer word or line gets a digest of its own.
WINDOW = 1 << 18

_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_ROLL = np.uint64(0xB5AD4ECEDA1CE2A9)
_ROW = np.uint64(0x9E6C63D0676A9A99)
_LENGTH = np.uint64(0xA24BAED4963EE407)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
#: First bytes of characters that belong to words.
_LETTER = np.ones(256, bool)
_LETTER[[0x20, *range(0x09, 0x0E), *range(0x80, 0xC0)]] = False


@dataclass(frozen=True)
class RepetitionParams:
    """Limits in per cent.  ``run_limits``: for each length in words, the characters that may lie
    in runs of that length found twice or more; ``line_limit``: the characters that may lie in
    lines equal to an earlier one.  The first place of a run counts too, so the limits are twice the
    usual ones, which count later places only.  ``least_words`` and ``repeat_limit`` (words in
    windows of ``window`` words found twice or more) are the base rules, which come first."""

    run_limits: dict[int, int] = field(
        default_factory=lambda: {5: 30, 6: 28, 7: 26, 8: 24, 9: 22, 10: 20})
    line_limit: int = 20
    least_words: int = 50
    repeat_limit: int = 50
    window: int = 3


@cache
def _powers(base: int) -> np.ndarray:
    out = np.full(WINDOW, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each of the spans, which are in order and do not overlap.

    Bytes are summed with powers of a base up to ``WINDOW`` bytes at a time, so memory does not
    grow with the length of a text.
    """
    out = np.empty(len(starts), np.uint64)
    up, down = _powers(_BASE), _powers(_INVERSE)
    i = 0
    while i < len(starts):
        low = int(starts[i])
        stop = int(np.searchsorted(ends, low + WINDOW - 1, side="right"))
        if stop <= i:
            digest = hashlib.blake2b(data[low:int(ends[i])].tobytes(), digest_size=8).digest()
            out[i] = int.from_bytes(digest, "little")
            i += 1
            continue
        part = data[low:int(ends[stop - 1])]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=total[1:])
        a, b = starts[i:stop] - low, ends[i:stop] - low
        out[i:stop] = mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64) * _LENGTH)
        i = stop
    return out


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys)
    same = np.diff(keys[order]) == 0
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a run of ``n`` words that begins at one of ``at``."""
    step = np.bincount(at, minlength=size + 1)[:size + 1] \
        - np.bincount(at + n, minlength=size + 1)[:size + 1]
    return np.cumsum(step)[:size] > 0


def _per_row(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the entries of ``firsts``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return np.diff(total[firsts])


def _counted(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Marked bytes of each row."""
    places = np.flatnonzero(mask)
    return np.diff(np.searchsorted(places, offsets))


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every line with a word."""
    cuts = np.flatnonzero(data == 10)
    row_ends = offsets[1:]
    ends = np.sort(np.concatenate([cuts, row_ends]), kind="stable")
    starts = np.sort(np.concatenate([offsets[:-1], cuts + 1]), kind="stable")
    words = np.flatnonzero(_LETTER[data])
    full = np.searchsorted(words, ends) > np.searchsorted(words, starts)
    starts, ends = starts[full], ends[full]
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def measure(data: np.ndarray, offsets: np.ndarray, params: RepetitionParams) -> dict:
    """Counts for each row of the bytes between ``offsets``."""
    starts, ends, firsts = word_spans(data, offsets)
    counts, size = np.diff(firsts), len(starts)
    row = np.repeat(np.arange(len(counts)), counts)
    letters = np.flatnonzero(_LETTER[data])
    chars = np.searchsorted(letters, ends) - np.searchsorted(letters, starts)
    out = {"n_words": counts, "word_chars": _per_row(chars, firsts),
           "n_symbols": _counted(_SYMBOL[data], offsets)}

    line_start, line_end, line_row = _lines(data, offsets)
    keys = span_hashes(data, line_start, line_end) + mix(line_row.astype(np.uint64) * _ROW)
    order = np.argsort(keys, kind="stable")
    later = np.zeros(len(keys), bool)
    later[order[1:][np.diff(keys[order]) == 0]] = True
    out["n_dup_lines"] = np.bincount(line_row[later], minlength=len(counts))
    held = np.searchsorted(letters, line_end[later]) - np.searchsorted(letters, line_start[later])
    out["dup_line_chars"] = np.bincount(line_row[later], held, len(counts)).astype(np.int64)

    words = span_hashes(data, starts, ends)
    salt, rolled, last = mix(row.astype(np.uint64) * _ROW), words, firsts[1:][row]
    lengths = {params.window, *params.run_limits}
    for n in range(1, max(lengths) + 1):
        if n > 1:  # the hash of n - 1 words rolls on over the next one
            rolled = rolled[:max(size - n + 1, 0)] * _ROLL + words[n - 1:]
        if n not in lengths:
            continue
        begins = np.flatnonzero(np.arange(len(rolled)) + n <= last[:len(rolled)])
        twice = begins[_repeated(mix(rolled[begins]) + salt[begins])]
        inside = _covered(twice, n, size)
        if n == params.window:
            out["n_repeat_words"] = _per_row(inside, firsts)
        if n in params.run_limits:
            out[f"dup_chars_{n}"] = _per_row(chars * inside, firsts)
    return out


def repetition_rules(docs: DataFrame, params: RepetitionParams = RepetitionParams(),
                     key: str = "doc_id", column: str = "text") -> DataFrame:
    """``key``, counts, ``base_failed``, ``failed`` (the rules a text breaks) and ``kept``, one
    row for each row of ``docs``.

    Words are runs outside ``\\x20 \\x09-\\x0D``, as written (case tells them apart).  Counts:
    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines with
    a word, equal to an earlier one), ``n_repeat_words``, ``dup_line_chars`` (of those lines) and
    ``dup_chars_<n>`` (in runs of ``n`` words found twice or more, the first included).

    NULL and empty texts have no words and fail the base rules.  Rows are judged alone: repeated
    rows get equal results, a NULL key stays NULL, other columns are ignored.  A text is never cut:
    a very long one is hashed ``WINDOW`` bytes at a time.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
              "dup_line_chars", *[f"dup_chars_{n}" for n in sorted(params.run_limits)]]

    def judge(batches):
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                found = measure(data, offsets, params)
                ids = batch.column(0).slice(first, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array(found[c].astype(np.int64)) for c in counts]], ["key", *counts])

    own = docs.select(F.col(key).alias("key"), F.col(column).cast("string").alias("text"))
    kind = own.schema["key"].dataType.simpleString()
    found = own.mapInArrow(judge, f"key {kind}, " + ", ".join(f"{c} long" for c in counts))
    base = (F.col("n_words") < params.least_words) | (
        100 * F.col("n_repeat_words") > params.repeat_limit * F.col("n_words"))
    rules = {"lines": 100 * F.col("dup_line_chars") > params.line_limit * F.col("word_chars")} | {
        f"runs_{n}": 100 * F.col(f"dup_chars_{n}") > limit * F.col("word_chars")
        for n, limit in sorted(params.run_limits.items())}
    broken = F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()])
    return (found.withColumnRenamed("key", key).withColumn("base_failed", base)
            .withColumn("failed", F.filter(broken, lambda x: x.isNotNull()))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)))

"""Token counts by byte-pair merging, without identifiers.

A segment's symbols form a linked list; a heap holds its adjacent pairs that the vocabulary can
join, lowest rank first and leftmost among equals.  The count is the number of initial symbols
less the merges; a symbol that no merge reached and the vocabulary lacks counts its bytes.

No piece of the vocabulary goes on past a following space mark, and none holds a line feed (both
are verified when a model is loaded), so a text falls into segments that merge independently, and
the counts of segments seen before are kept, up to a fixed number.
"""

from __future__ import annotations

import re
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from estatelens.llm.textbytes import text_slices

MARK = "▁"
KEPT_SEGMENTS = 600_000
_RUNS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class PieceCounter:
    """Counts tokens as the piece model at ``path`` makes them (no added begin or end)."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        if any(model.is_unused(i) for i in ids):
            raise ValueError("models with unused pieces are not supported")
        probe = f" a  b{MARK}\n\tc ﬁ "
        if model.normalize(probe) != (MARK + probe).replace(" ", MARK):
            raise ValueError("only models without text normalisation are supported")
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in ids
                     if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
        if any(MARK in piece.lstrip(MARK) or "\n" in piece for piece in self.rank):
            raise ValueError("a piece goes on past a space mark or a line feed")
        self.seen: dict[bytes, int] = {}

    def count(self, segment: str) -> int:
        """Tokens of one segment, space marks included."""
        rank, symbols = self.rank, list(segment)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = [(rank[pair], i, 2) for i in range(n - 1)
                 if (pair := symbols[i] + symbols[i + 1]) in rank]
        heapify(pairs)
        merges = 0
        while pairs:
            _, i, size = heappop(pairs)
            j = after[i]
            if not symbols[i] or j == n or len(symbols[i]) + len(symbols[j]) != size:
                continue  # one side has been merged since
            symbols[i] += symbols[j]
            symbols[j] = ""
            merges += 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (pair := symbols[i] + symbols[k]) in rank:
                    heappush(pairs, (rank[pair], i, len(pair)))
            h = before[i]
            if h >= 0 and (pair := symbols[h] + symbols[i]) in rank:
                heappush(pairs, (rank[pair], h, len(pair)))
        spare = sum(len(s.encode()) - 1 for s in symbols if s and s not in rank)
        return n - merges + spare

    def _fresh(self, key: bytes) -> int:
        text = key.decode()
        if text[:1] == "\n":
            return 1 + (self.count(text[1:]) if len(text) > 1 else 0)
        return self.count(MARK + text)

    def count_text(self, raw: bytes) -> int:
        """Tokens of a whole UTF-8 text."""
        if not raw:
            return 0
        plain = raw.replace(b"\n", b" \n")
        if b"  " in plain or MARK.encode() in raw or raw[:1] in b" \n" or raw[-1:] == b" ":
            text = MARK + raw.decode().replace(" ", MARK)
            lines = text.split("\n")
            return len(lines) - 1 + sum(self.count(run) for line in lines
                                        for run in _RUNS.findall(line))
        segments = plain.split(b" ")
        seen = self.seen
        new = {s for s in segments if s not in seen}
        if len(seen) + len(new) > KEPT_SEGMENTS:
            seen.clear()
            new = set(segments)
        for segment in new:
            seen[segment] = self._fresh(segment)
        return sum(map(seen.__getitem__, segments))


@cache
def _counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs(doc_id, text, ...)``.

    NULL counts as empty: no bytes, no tokens.  Rows are returned one for one, repeated rows and
    rows without doc_id included; other columns are ignored.  No shuffle; memory is bounded by a
    slice of texts and the kept segments.
    """
    names = ["doc_id", "n_bytes", "n_tokens", "over_limit"]

    def count(batches):
        counter = _counter(path)
        for batch in batches:
            sizes, tokens = [], []
            for _, data, offsets in text_slices(batch.column(1)):
                raw = data.tobytes()
                bounds = offsets.tolist()
                sizes.append(np.diff(offsets))
                tokens += [counter.count_text(raw[a:b]) for a, b in zip(bounds, bounds[1:])]
            if tokens:
                total = np.array(tokens, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.concatenate(sizes)), pa.array(total),
                     pa.array(total > limit)], names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

"""Token counts, ids and packing against the public libraries."""

import weakref
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

from estatelens.llm.bytepairs import PieceCounter, token_counts
from estatelens.llm.packing import pack_documents, plan_sequences
from estatelens.llm.tokens import WordIds, release_chunks, word_ids

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")

ODD = [None, "", "  ", " a  b ", "\n\n x\n", " \n", "a \n b", "é ﬁ İ ΣΑΣ x▁y", "a▁▁b", "a" * 3000,
       "<|endoftext|> A<|startoftext|>b <|ENDOFTEXT|>", "it's DON'T 12,5 ... !!,, naïve ÉTÉ ß",
       "日本語 텍스트 x​z", "\x1c \x85 x", "<s> </s><0x0A>", "x\r\ny\tz", " lead", "trail ",
       "½²³ ٣", "été café", "word " * 5000, "😀😀 👩‍👩‍👧 x"]


@pytest.fixture(scope="module")
def rows():
    texts = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'")
    return texts.fetchall() + [(-1 - i, t) for i, t in enumerate(ODD)] + [(None, "no id")] * 2


def test_counts_equal_the_library(spark, rows):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows],
                                 "doc_id long, text string, n_tokens int")
    got = sorted((tuple(r) for r in token_counts(docs, PIECES, 100).collect()), key=repr)
    want = []
    for i, t in rows:
        n = len(model.encode(t or ""))
        want.append((i, len((t or "").encode()), n, n > 100))
    assert got == sorted(want, key=repr)
    assert token_counts(docs.limit(0), PIECES).count() == 0


def test_kept_segments_are_bounded(monkeypatch):
    monkeypatch.setattr("estatelens.llm.bytepairs.KEPT_SEGMENTS", 3)
    counter = PieceCounter(PIECES)
    once = counter.count_text(b"one two three four five")
    assert [counter.count_text(b"one two three four five") for _ in range(3)] == [once] * 3


def test_ids_equal_the_library(monkeypatch, rows):
    from tokenizers import Tokenizer

    monkeypatch.setattr("estatelens.llm.tokens.KEPT_CHUNKS", 2000)
    library, own = Tokenizer.from_file(WORDS), WordIds(WORDS)
    for low in range(0, len(rows), 50):
        texts = [t or "" for _, t in rows[low:low + 50]]
        ids, begin = own.encode([t.encode() for t in texts])
        for k, text in enumerate(texts):
            want = library.encode(text, add_special_tokens=False).ids + [0]
            assert ids[begin[k]:begin[k + 1]].tolist() == want, text[:80]


def test_released_encoder_and_its_chunks_go():
    encoder = word_ids(WORDS)
    encoder.encode([b"een, twee... drie?!"])
    alive = weakref.ref(encoder)
    del encoder
    release_chunks()
    assert alive() is None


def test_packing_keeps_every_id_once(spark, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows],
                                 "doc_id long, text string, length int")
    pieces = pack_documents(docs, WORDS, 256, keep_ids=True).collect()
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t in rows}
    total = sum(len(ids[i]) for i, _ in rows)
    assert sum(p.length for p in pieces) == total
    filled = {}
    for p in pieces:
        own = ids[p.doc_id][p.start:p.start + p.length]
        assert p.ids == own and p.start == 256 * p.piece
        assert p.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        filled.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(filled) <= 1.01 * -(-total // 256) + 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(docs, WORDS).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_all_pieces_and_fills_well(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(129, np.int64)
    lengths = rng.integers(1, 129, 3000) if seed % 2 else rng.choice([40, 48, 64, 80], 3000)
    np.add.at(counts, lengths, 1)
    used, sequences = np.zeros(129, np.int64), 0
    for parts, n in plan_sequences(counts):
        assert sum(parts) <= 128 and n > 0
        sequences += n
        for x in parts:
            used[x] += n
    assert (used == counts).all()
    assert sequences <= 1.02 * -(-int(lengths.sum()) // 128) + 1


def test_exact_complements_come_first():
    counts = np.zeros(11, np.int64)
    counts[[7, 3, 6, 2, 4]] = [1, 1, 1, 2, 1]
    assert sorted(plan_sequences(counts)) == [((2, 2), 1), ((6, 4), 1), ((7, 3), 1)]
    counts = np.zeros(11, np.int64)
    counts[[4, 2, 3, 1]] = [1, 1, 1, 1]
    assert plan_sequences(counts) == [((4, 3, 2, 1), 1)]

"""Token ids of whole texts, from a vocabulary of word-end byte pairs.

The vocabulary drops white space and never joins across it, so a text is encoded chunk by chunk
between ASCII white space.  Arrow splits the texts of a slice and numbers their different chunks;
each of these is encoded once by the library, and the ids of all texts are taken from theirs.
Chunks of ordinary length are kept for later slices, up to a fixed number; long ones never are.
"""

from __future__ import annotations

import re
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from estatelens.llm.textbytes import give_back

KEPT_CHUNKS = 500_000
KEPT_LENGTH = 48
KEPT_MARKS = 4
_PLAIN = re.compile("([a-zß-öø-ÿ]+)([.,;:!?]*)")


def _byte_alphabet() -> dict[int, str]:
    """The usual printable stand-in of each byte: itself where printable, else from 256 upwards."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class WordIds:
    """Ids of ``path``'s tokenizer for batches of raw texts; ``end`` is appended to each."""

    def __init__(self, path: str, end: int = 0):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.alphabet = _byte_alphabet()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.end = end
        self.kept: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _library(self, chunk: str) -> list[int]:
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids

    def _encode(self, chunk: str) -> bytes:
        """The ids of one chunk, four bytes each."""
        plain = _PLAIN.fullmatch(chunk)
        if plain is None:
            return _packed(self._library(chunk)) if chunk else b""
        # one lower-case word: the library's merges alone, on its byte alphabet
        word = plain[1]
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.alphabet)
        ids = _packed([token.id for token in self.model.tokenize(word)])
        return ids + self._punctuation(plain[2]) if plain[2] else ids

    def _punctuation(self, run: str) -> bytes:
        # kept by the encoder itself: a cache of the class would keep the encoder and its chunks
        ids = self.marks.get(run)
        if ids is None:
            ids = _packed(self._library(run))
            if len(run) <= KEPT_MARKS:
                self.marks[run] = ids
        return ids

    def _ids(self, chunks: list[str]) -> list[bytes]:
        """The ids of each of these different chunks."""
        kept = self.kept
        found = list(map(kept.get, chunks))
        if len(kept) + found.count(None) > KEPT_CHUNKS:
            # start anew with what this slice has in common with those before
            kept = self.kept = {c: ids for c, ids in zip(chunks, found) if ids is not None}
        for at, ids in enumerate(found):
            if ids is None:
                chunk = chunks[at]
                ids = found[at] = self._encode(chunk)
                if len(chunk) <= KEPT_LENGTH and len(kept) < KEPT_CHUNKS:
                    kept[chunk] = ids
        return found

    def encode(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and where each text begins (one entry more)."""
        texts = pa.array(raws, pa.large_binary()).cast(pa.large_string())
        # the vocabulary is lower-case; its special tokens are matched as written
        lower = pc.ascii_lower(texts)
        special = pc.match_substring_regex(lower, "|".join(map(re.escape, self.specials)))
        if pc.any(special).as_py():
            lower = pc.if_else(special, texts, lower)
        split = pc.ascii_split_whitespace(lower)
        numbered = split.flatten().dictionary_encode()
        ids = self._ids(numbered.dictionary.to_pylist()) + [_packed([self.end])]
        # every text is followed by the end, which stands behind the chunks' ids
        stops = split.offsets.to_numpy()[1:]
        chunks = np.insert(numbered.indices.to_numpy(), stops, len(ids) - 1)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        of_chunks = pa.LargeListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)])),
            pa.array(np.frombuffer(b"".join(ids), np.uint32)))
        every = of_chunks.take(pa.array(chunks))
        begin = every.offsets.to_numpy()[np.concatenate([[0], stops + np.arange(len(raws)) + 1])]
        return every.flatten().to_numpy(), begin


@cache
def word_ids(path: str, end: int = 0) -> WordIds:
    """The encoder of this worker."""
    return WordIds(path, end)


def release_chunks() -> None:
    """Lets a reused worker that turns to another operator give up the chunks it kept."""
    word_ids.cache_clear()
    give_back()

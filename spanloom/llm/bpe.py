"""BPE encoding and decoding with reuse of content-defined chunks.

A text is cut where a rolling hash of the last characters says so, hence passages that documents share
are cut alike. Of each chunk the whole words are encoded once per worker and kept by the chunk's text;
the word pieces at its two ends are not. At a join the pieces of both sides are put together again and
encoded as one, over as many chunks as it takes until white space stands on either side: the tokenizer
never joins characters over white space, so from there on both encodings agree exactly.

The stores of chunks and words live in a worker and are emptied when full, which costs time only. A
store for the whole cluster would have to move all text.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.rows import map_rows

WINDOW = 8  # characters under the rolling hash
MASK = 127  # one position of 128 is a cut
LONGEST = 200  # characters of a word that is kept
WORDS = 800_000  # words kept in a worker
CHUNKS = 50_000  # chunks kept in a worker

_FACTORS = np.array([pow(0x9E3779B1, k + 1, 1 << 32) for k in range(WINDOW)], np.uint32)
_NOT_SPACE = re.compile("[\x1c-\x1f]")  # white space for Python, none for the tokenizer


def cuts(text: str) -> list[int]:
    """Ends of the chunks of ``text``; a cut depends on the ``WINDOW`` characters before it alone."""
    n = len(text)
    if n <= WINDOW:
        return [n]
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    mixed = np.zeros(n - WINDOW, np.uint32)
    for k in range(WINDOW):
        mixed += code[k : n - WINDOW + k] * _FACTORS[k]
    found = (np.flatnonzero((mixed >> 20) & MASK == 0) + WINDOW).tolist()
    found.append(n)
    return found


class ChunkCoder:
    """Encodes and decodes texts with the tokenizer file at ``path``."""

    def __init__(self, path: str, words: int = WORDS, chunks: int = CHUNKS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.limits = words, chunks
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, tuple | None] = {}
        self.tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        # a tokenizer that drops white space before it looks for words, and marks where words end
        self.cut_at_space = self.tokenizer.encode("a b").ids == self.tokenizer.encode(" a \n b ").ids
        self.ends_word = np.array([t.endswith("</w>") for t in self.tokens])

    def _word(self, word: str) -> bytes:
        """Ids of a word as little-endian 32-bit integers."""
        found = self.words.get(word)
        if found is None:
            found = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        return found

    def _learn(self, words: list[str]) -> None:
        """Encodes words that are not kept yet: plain ones in one text, the others each alone."""
        if len(self.words) > self.limits[0]:
            self.words.clear()
        plain, parts, rest = [], [], []
        for word in words:
            core = word[:-1] if word[-1] in ".," else word
            if core.isalpha() and core.lower().isalpha():
                plain.append(word)
                parts.append(1 if core is word else 2)
            elif len(word) <= LONGEST:
                rest.append(word)
        if plain:
            ids = self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == sum(parts) and ends[-1] == len(ids):
                flat = array("I", ids).tobytes()
                start = 0
                for word, end in zip(plain, (4 * ends[np.cumsum(parts) - 1]).tolist(), strict=True):
                    self.words[word] = flat[start:end]
                    start = end
            else:
                rest += plain
        if rest:
            for word, coded in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
                self.words[word] = array("I", coded.ids).tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        known = self.words
        if new := [w for w in dict.fromkeys(words) if w not in known]:
            self._learn(new)
        return [known.get(w) or self._word(w) for w in words]

    def _prepare(self, chunks: list[str]) -> None:
        """Keeps each chunk with its head piece, the ids of its whole words and its tail piece; a chunk
        without white space is kept as None."""
        if len(self.chunks) > self.limits[1]:
            self.chunks.clear()
        taken, flat = [], []
        for chunk in chunks:
            words = chunk.split()
            head = tail = ""
            if words and not chunk[0].isspace():
                if len(words) == 1 and not chunk[-1].isspace():
                    self.chunks[chunk] = None
                    continue
                head = words.pop(0)
            if words and not chunk[-1].isspace():
                tail = words.pop()
            taken.append((chunk, head, len(flat), len(flat) + len(words), tail))
            flat += words
        coded = self._words(flat)
        for chunk, head, start, end, tail in taken:
            self.chunks[chunk] = head, b"".join(coded[start:end]), tail

    def encode(self, text: str | None) -> bytes:
        """Ids of the text as little-endian 32-bit integers."""
        if not text:
            return b""
        if _NOT_SPACE.search(text) or not self.cut_at_space:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        ids: list[bytes] = []
        places, joined = [], []  # where the ids of joins go, and their words
        piece: list[str] = []
        ends = cuts(text)
        for at in range(0, len(ends), 256):  # not more chunks at a time than the store holds
            part = [text[i:j] for i, j in zip([ends[at - 1] if at else 0, *ends[at:]], ends[at : at + 256], strict=False)]
            if any(c not in self.chunks for c in part):
                self._prepare([c for c in dict.fromkeys(part) if c not in self.chunks])
                if any(c not in self.chunks for c in part):  # the store was emptied
                    self._prepare(list(dict.fromkeys(part)))
            for chunk in part:
                found = self.chunks[chunk]
                if found is None:
                    piece.append(chunk)
                    continue
                if found[0]:
                    piece.append(found[0])
                if piece:
                    places.append(len(ids))
                    joined.append("".join(piece))
                    ids.append(b"")
                ids.append(found[1])
                piece = [found[2]] if found[2] else []
        if piece:
            places.append(len(ids))
            joined.append("".join(piece))
            ids.append(b"")
        for place, coded in zip(places, self._words(joined), strict=True):
            ids[place] = coded
        return b"".join(ids)

    def decode(self, ids: bytes) -> str:
        numbers = array("I", ids)
        if self.tokenizer.decoder is not None:
            return self.tokenizer.decode(numbers.tolist(), skip_special_tokens=False)
        return " ".join([self.tokens[i] for i in numbers])  # what a tokenizer without decoder does

    def code(self, text: str | None) -> tuple[bytes, str]:
        """Ids of the text and the text that they decode to."""
        ids = self.encode(text)
        return ids, self.decode(ids)


_CODERS: dict[str, ChunkCoder] = {}


def coder(path: str) -> ChunkCoder:
    """The worker's coder: its stores outlive a task."""
    if path not in _CODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _CODERS[path] = ChunkCoder(path)
    return _CODERS[path]


def encode_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, ``ids`` (binary, little-endian 32-bit), ``decoded`` (string).

    Null and empty texts have no ids and decode to the empty string. Texts are encoded whole, however
    long. Rows with null or repeated keys are coded like all others; other columns are not read.
    """
    slim = docs.select(F.col(key), F.col(text).alias("_text"))
    return map_rows(slim, lambda: coder(path).code, ["_text"], "ids binary, decoded string").drop("_text")

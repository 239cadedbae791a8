"""Token ids of whole texts by a tokenizer file of the ``tokenizers`` library, with a word cache.

A byte-level tokenizer never joins tokens across a place where a space follows one non-space character and precedes
another. Texts are cut there, each distinct piece is encoded once per worker by the library, and a text's ids are the
ids of its pieces in turn. The result equals encoding the whole text; long texts need no more memory than their ids.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from array import array

import numpy as np

from fleet.llm.common import take_worker

CACHED = 800_000
_LONGEST_CACHED = 64
_MARKS = ".,!?;:"
_OTHER_SPACE = re.compile(r"[^\S \n]")
_CUTS = re.compile(r"(?<=\S)(?= \S)")


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others follow from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return {b: chr(b if b in shown else next(hidden)) for b in range(256)}


class _Spaced(dict):
    """Ids of pieces that begin with a space, by the piece without it."""

    def __init__(self, pieces: Encoder):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, word: str) -> bytes:
        ids = self.pieces.find(" " + word)
        if len(word) < _LONGEST_CACHED:
            self[word] = ids
        return ids


class Encoder(dict):
    """Encodes texts to little-endian unsigned 16- or 32-bit ids, as bytes. As a dict: the ids of pieces seen so far."""

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.library.model
        self.spaced = _Spaced(self)
        self.dtype, self.code = ("<u2", "H") if self.library.get_vocab_size() <= 1 << 16 else ("<u4", "I")
        self.letters = _byte_letters()
        #: Words may go straight to the library's model if its first step is the plain byte-level split.
        rules = json.loads(self.library.to_str())
        step = rules["pre_tokenizer"] or {}
        self.plain = step.get("type") == "ByteLevel" and step.get("use_regex") and not step.get("add_prefix_space") and not rules["normalizer"]

    def __missing__(self, piece: str) -> bytes:
        ids = self.find(piece)
        if len(piece) <= _LONGEST_CACHED:
            self[piece] = ids
        return ids

    def _get(self, piece: str) -> bytes:
        return self.spaced[piece[1:]] if piece[0] == " " else self[piece]

    def find(self, piece: str) -> bytes:
        """Ids of a piece, from its parts or from the library."""
        core = piece.rstrip(_MARKS)
        if (core[1:] if core[:1] == " " else core).isalpha() and self.plain:
            if len(core) < len(piece):
                return self._get(core) + self[piece[len(core) :]]
            word = core.encode().decode("latin-1").translate(self.letters)
            return array(self.code, [t.id for t in self.model.tokenize(word)]).tobytes()
        left, line, right = piece.partition("\n") if len(piece) <= _LONGEST_CACHED else (piece, "", "")
        if self.plain and left.strip() and right and not left[-1].isspace() and not right[0].isspace():
            return self._get(left) + self[line] + self[right]
        found = self.library.encode_batch_fast([piece], add_special_tokens=False)[0]
        return array(self.code, found.ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; a null text is empty."""
        out = []
        for text in texts:
            if len(self) + len(self.spaced) > CACHED:
                self.clear()
                self.spaced.clear()
            if not text:
                out.append(b"")
            elif "  " in text or "\n \n" in text or text[-1] == " " or _OTHER_SPACE.search(text):
                out.append(b"".join(map(self.__getitem__, _CUTS.split(text))))
            else:  # every space but a first one stands before a piece
                first, *rest = text.split(" ")
                out.append((self[first] if first else b"") + b"".join(map(self.spaced.__getitem__, rest)))
        return out

    def ids(self, encoded: bytes) -> np.ndarray:
        return np.frombuffer(encoded, self.dtype)


@functools.lru_cache(maxsize=2)
def _kept_encoder(path: str) -> Encoder:
    return Encoder(path)


def encoder(path: str) -> Encoder:
    """One per worker process and tokenizer file."""
    take_worker("bpe", _kept_encoder.cache_clear)
    return _kept_encoder(path)


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())

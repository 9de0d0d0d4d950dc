"""Token ids of texts by a public tokenizer, fast over many texts.

The vocabulary's pre-tokenizer never joins two words across ASCII white space, so a text's ids are
those of its words, and a word is encoded once per worker. Within a word it parts Latin letters from a
tail of ASCII punctuation, so both are encoded once, whatever they stand with, and the letters go
straight to the vocabulary's merges, without the regular expressions that the rest goes through. Words
are looked up as UTF-8, whose split knows ASCII white space only. Ids travel as little-endian bytes.
"""

from __future__ import annotations

import os
import string
import sys
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers

WORD_BPE = "word_bpe_49k.json"
END = 2
#: Words remembered by a worker: those of the current and of the last so many new ones.
REMEMBERED = 500_000
PUNCTUATION = string.punctuation.encode()
#: The byte-level alphabet: printable bytes stand for themselves, the others for what follows 255.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}


def default_tokenizer() -> str:
    return public_tokenizers.path(WORD_BPE)


class Known(dict):
    """The ids of words as bytes; a word that is not there is encoded."""

    def __init__(self, encoder: Encoder, before: dict[bytes, bytes]) -> None:
        self.encoder, self.before = encoder, before

    def __missing__(self, word: bytes) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.encoder.word(word, self)
        self[word] = ids
        return ids


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.dtype, self.code = np.dtype("<u2" if small else "<u4"), "H" if small else "I"
        self.known = Known(self, {})

    def encode(self, texts: list[str], end: int = END) -> list[bytes]:
        """The ids of every text and the end id, as bytes of ``dtype``; None is an empty text."""
        last, out = self.packed([end]), []
        for text in texts:
            text = text or ""
            # Upper-case ASCII is folded by the tokenizer anyway; its control strings are not.
            if text.isascii() and "<|" not in text:
                text = text.lower()
            if len(self.known) > REMEMBERED:
                self.known.before = {}
                self.known = Known(self, self.known)
            out.append(b"".join(map(self.known.__getitem__, text.encode().split())) + last)
        return out

    def word(self, word: bytes, known: Known) -> bytes:
        body = word.rstrip(PUNCTUATION)
        letters = body.decode()
        if letters.isalpha():
            # below U+0250 letters are composed and have one lower case, but for the dotted I
            ascii_ = letters.isascii()
            if ascii_ or (max(letters) < "\u0250" and "\u0130" not in letters):
                if len(body) < len(word):
                    return known[body] + known[word[len(body):]]
                shown = letters.lower()
                if not ascii_:
                    shown = shown.encode().decode("latin-1").translate(BYTE_LETTERS)
                return self.packed([t.id for t in self.merge(shown)])
        return self.packed(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)

    def packed(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)

"""Token ids of whole texts, with the words already met kept at hand."""

from __future__ import annotations

import os
import re
import struct

import numpy as np
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

# Words of each of two generations that a worker remembers.
MEMORY = 250_000
# A run of western letters, each one code point in any case, and then of signs but apostrophes.
LETTERS = "A-Za-zÀ-ÖØ-Þà-öø-þ"
PLAIN = re.compile(rf"([{LETTERS}]+)([!-&(-/:-@\[-`{{-~]*)").fullmatch
PACK = [struct.Struct(f"<{n}I").pack for n in range(64)]


class Words(dict):
    """Ids of words; a word not met before is worked out when it is asked for."""

    def __init__(self, make, older: dict[str, bytes] | None = None):
        super().__init__()
        self.make, self.older = make, older or {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.make(word)
        self[word] = ids
        return ids


class WordEncoder:
    """Ids of texts by a tokenizer that never joins what white space parts.

    Such a tokenizer gives a text the ids of its words, one after the other, so that it is only
    asked for words not met before. Any other (``parts``: probed, not assumed) is asked for whole
    texts. If it also lower-cases and parts letters from punctuation
    (``folds``: probed, not assumed), plain words go straight to its model, without the capital
    and the full stop. ``tests/llm`` compares all this with encoding whole texts.
    """

    def __init__(self, path: str, *, special_as_text: bool = False, memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.model = self.tokenizer.model.tokenize
        octets = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        # How the bytes of each western letter are written in the model's vocabulary.
        self.spelling = {ord(c): octets(c)[0][0] for c in map(chr, range(0xC0, 0x100))}
        self.memory = memory
        self.parts = self._parts()
        self.folds = self.parts and self._folds()
        self.known = Words(self._word)
        self.ends: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        """The model's ids of lower-case letters alone, or of punctuation alone."""
        spelt = part if part.isascii() else part.translate(self.spelling)
        ids = [piece.id for piece in self.model(spelt)]
        return PACK[len(ids)](*ids) if len(ids) < 64 else np.array(ids, "<u4").tobytes()

    def _parts(self) -> bool:
        probe = "The quick, brown\tfox  jumps\n over\u00a0the 12 lazy dogs. "
        return self._whole(probe) == b"".join(map(self._whole, probe.split()))

    def _folds(self) -> bool:
        return all(
            self._whole(word.title() + end) == self._part(word) + (self._part(end) if end else b"")
            for word in ("the", "zqxjv", "internationalisation", "élan", "straße", "ñandú")
            for end in ("", ".", ",", "?!", "###", "_/")
        )

    def _word(self, word: str) -> bytes:
        if not self.folds:
            return self._whole(word)
        if word.isascii() and word.isalpha():
            letters, end = word, ""
        elif found := PLAIN(word):
            letters, end = found.groups()
        else:
            return self._whole(word)
        low = letters.lower()
        # Most such words never come bare: these are not remembered for it.
        ids = None if low == word else self.known.get(low) or self.known.older.get(low)
        if ids is None:
            ids = self._part(low)
        if not end:
            return ids
        if end not in self.ends:
            if len(self.ends) > 1000:
                self.ends = {}
            self.ends[end] = self._part(end)
        return ids + self.ends[end]

    def ids(self, text: str | None) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers; a null has none."""
        if not text:
            return b""
        # Python takes these four for white space, a tokenizer does not.
        if not self.parts or "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return self._whole(text)
        if len(self.known) > self.memory:
            # Words met lately stay at hand; those not met for two generations are forgotten.
            self.known.older = {}
            self.known = Words(self._word, older=self.known)
        return b"".join(map(self.known.__getitem__, text.split()))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return [self.ids(text) for text in texts]


_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def encoder(path: str, *, special_as_text: bool = False) -> WordEncoder:
    """This Python worker's encoder, kept from task to task."""
    key = path, special_as_text
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path, special_as_text=special_as_text)
    return _ENCODERS[key]

"""Token ids of texts by a vocabulary file of lower-case byte pairs with word ends.

Such a tokenizer splits a text into letter runs, single digits and runs of other signs, and merges
within each of these pieces alone. So the ids of a plain text (ASCII and precomposed Latin letters,
without special-token strings) are those of its blank-separated words, and a word's those of its
pieces. Words and pieces repeat, so bounded caches hold their ids. Every other text goes to the
tokenizer as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

CACHE = 500_000

# Characters whose lower case, normal form and class are the same for every engine.
_LETTER = "a-zß-öø-ÿā-įĳ-ň"
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-įĲ-ň]*")
_PIECES = re.compile(
    rf"[{_LETTER}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\t\n\r {_LETTER}0-9]+"
)


class _Filled(dict):
    """A dict that computes a missing value from its key."""

    def __init__(self, compute: Callable[[str], bytes]):
        self._compute = compute

    def __missing__(self, key: str) -> bytes:
        value = self[key] = self._compute(key)
        return value


class Tokens:
    """Ids as little-endian unsigned 32-bit numbers, with ``end`` appended."""

    def __init__(self, path: str, end: int | None = None):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._merge = self._tokenizer.model.tokenize
        self._end = b"" if end is None else np.uint32(end).tobytes()
        self._words = _Filled(self._word)
        self._pieces: dict[str, bytes] = {}
        split = self._tokenizer.pre_tokenizer.pre_tokenize_str
        # How the tokenizer spells a character's bytes before it merges them.
        self._spelt = {
            c: "".join(p for p, _ in split(chr(c))) for c in range(0x21, 0x149) if _PLAIN.fullmatch(chr(c))
        }

    def _slow(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        merged = self._merge(piece.translate(self._spelt))
        return b"".join([token.id.to_bytes(4, "little") for token in merged])

    def ids(self, text: str | None) -> bytes:
        if not text:
            return self._end
        if "<|" in text or not _PLAIN.fullmatch(text):
            return self._slow(text) + self._end
        words = text.lower().split()
        if len(self._words) > CACHE:
            self._words.clear()
        return b"".join(map(self._words.__getitem__, words)) + self._end

    def _word(self, word: str) -> bytes:
        known, out = self._pieces, []
        for piece in _PIECES.findall(word):
            ids = known.get(piece)
            if ids is None:
                if len(known) >= CACHE:
                    known.clear()
                ids = known[piece] = self._piece(piece)
            out.append(ids)
        return b"".join(out)

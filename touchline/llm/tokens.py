"""Whole texts to token ids with the tokenizers library, by way of a bounded cache of the pieces between spaces.

Both kinds of tokenizer used here never merge across a space that stands between a letter or sign and another one, so the ids of
a text are the ids of its pieces in order. Texts for which that is not certain go through the library whole.
"""

from __future__ import annotations

import os
import re
from array import array

from touchline.llm.common import worker_kept

# A word of Latin letters, maybe after a space and before signs: both kinds take the word and the signs apart and neither
# normalises it further than to lower case, so the merge table of the library can be asked directly, which is much quicker.
_PLAIN = re.compile(r"( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_BEFORE_WORD = re.compile(r"(?= \S)")
_ODD_SPACE = re.compile(r" (?:\s|$)")


CACHE_BYTES = 160 << 20  # about, of each worker
LONGEST_KEPT = 64  # letters of a piece that is kept; text without blanks is one long piece that will hardly come again
_ENTRY_BYTES = 220


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where printable, else the next free one from 256."""
    shown = {b for b in range(256) if chr(b).isprintable() and b != 32}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def drop_spaces(text: str) -> list[str]:
    """Pieces for a tokenizer that treats every run of white space as one break and drops it."""
    return text.replace("\n", " ").split(" ")


def lead_spaces(text: str) -> list[str]:
    """Pieces for a tokenizer that keeps a single space with the word after it; other white space stays inside a piece."""
    if _ODD_SPACE.search(text):
        return _BEFORE_WORD.split(text)
    first, *rest = text.split(" ")
    return [first, *map(" ".__add__, rest)]


class _Pieces(dict):
    """Piece to id bytes; a piece that is not there is encoded when first asked for."""

    def __init__(self, library, lower: bool, limit: int):
        self._library, self._tokenize, self._lower, self._limit, self.held = library, library.model.tokenize, lower, limit, 0
        self._letters, self._signs = _byte_letters(), {}

    def _merged(self, text: str) -> list[int]:
        if not text.isascii() or text[0] == " ":
            text = text.encode().decode("latin-1").translate(self._letters)
        return [t.id for t in self._tokenize(text)]

    def __missing__(self, piece: str) -> bytes:
        if plain := _PLAIN.fullmatch(piece):
            space, word, signs = plain.groups()
            ids = self._merged(space + (word.lower() if self._lower else word))
            if signs:
                merged = self._signs.get(signs) or self._merged(signs)
                if len(signs) <= LONGEST_KEPT:
                    self._signs[signs] = merged
                ids += merged
        else:
            ids = self._library.encode(piece, add_special_tokens=False).ids
        data = array("I", ids).tobytes()
        if len(piece) <= LONGEST_KEPT:
            self.held += _ENTRY_BYTES + len(piece) + len(data)
            if self.held > self._limit:
                self.clear()
                self._signs.clear()
                self.held = 0
            self[piece] = data
        return data


class CachedTokenizer:
    """ids(text) gives what encode(text, add_special_tokens=False) gives, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, pieces, limit: int = CACHE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._special = [t.content for t in self._library.get_added_tokens_decoder().values()]
        self._pieces, self._get = pieces, _Pieces(self._library, pieces.__name__ == "drop_spaces", limit).__getitem__

    def ids(self, text: str | None) -> bytes:
        """Null counts as empty. A text that holds the string of a special token is left to the library."""
        text = text or ""
        if any(s in text for s in self._special):
            return array("I", self._library.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self._get, self._pieces(text)))


def worker_tokenizer(path: str, pieces) -> CachedTokenizer:
    """The tokenizer of this Python worker, which tasks of one function that run in it one after the other share."""
    kept, key = worker_kept(), f"{path} {pieces.__name__}"
    if key not in kept:
        kept[key] = CachedTokenizer(path, pieces)
    return kept[key]

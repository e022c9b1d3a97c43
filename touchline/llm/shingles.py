"""Sets of five-word shingles of whole texts as sorted 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import hashlib

import numpy as np

from touchline.llm.common import mix64

WORDS = 5
_BASE = 0x9E3779B97F4A7C15
# A-Z in lower case, the other white space of ASCII as blanks, all other bytes as they are.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
_WEIGHTS = [pow(_BASE, 2 * j + 3, 1 << 64) for j in range(16)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Shingler:
    """Holds the powers of the base, which grow to the longest run of bytes seen."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self._up = self._down = np.empty(0, np.uint64)

    def sets(self, texts: list[str | None], run_bytes: int = 1 << 20) -> list[np.ndarray]:
        """For each text its distinct shingles; a text with fewer words is one shingle, one without words has none."""
        out, held, used = [], [], 0
        for text in texts:
            data = (text or "").encode("utf-8", "surrogatepass")
            if held and used + len(data) > run_bytes:
                out += self._run(held)
                held, used = [], 0
            held.append(data)
            used += len(data) + 1
        return out + (self._run(held) if held else [])

    def _run(self, texts: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b" ".join([*texts, b""]).translate(_FOLD), np.uint8)
        if len(self._up) <= len(data):
            self._up = _powers(_BASE, 2 * len(data) + 1)
            self._down = _powers(pow(_BASE, -1, 1 << 64), 2 * len(data) + 1)
        with np.errstate(over="ignore"):
            word = np.r_[False, data != 32, False]
            edge = np.flatnonzero(word[1:] != word[:-1])
            start, end = edge[::2], edge[1::2]
            total = np.r_[np.uint64(0), np.cumsum(data.astype(np.uint64) * self._up[: len(data)], dtype=np.uint64)]
            hashes = mix64((total[end] - total[start]) * self._down[start] + (end - start).astype(np.uint64) * np.uint64(_WEIGHTS[0]))
            limits = np.cumsum([len(t) + 1 for t in texts])
            last = np.searchsorted(start, limits)
            first = np.r_[0, last[:-1]]
            k = self.words
            n = max(0, len(hashes) - k + 1)
            grams = np.zeros(n, np.uint64)
            for j in range(k):
                grams += hashes[j : j + n] * np.uint64(_WEIGHTS[j])
            grams = mix64(grams)
            out = []
            for a, b in zip(first.tolist(), last.tolist()):
                if b - a >= k:
                    out.append(np.unique(grams[a : b - k + 1]))
                elif b > a:
                    short = np.uint64(_WEIGHTS[10 + b - a])
                    for j in range(a, b):
                        short = short + hashes[j] * np.uint64(_WEIGHTS[j - a])
                    out.append(mix64(np.array([short], np.uint64)))
                else:
                    out.append(np.empty(0, np.uint64))
        return out


def set_name(tokens: np.ndarray) -> bytes | None:
    """16 bytes that stand for the set; None for the empty one."""
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None

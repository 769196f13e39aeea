"""Words of a text and hashes of runs of words; small helpers used inside tasks."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import xxhash

_LETTER_RUN = re.compile(r"\w+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xFF51AFD7ED558CCD)
_MIX_B = np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)


def blank_words(text: str | None) -> list[bytes]:
    """Runs of ``[^\\x20\\x09-\\x0D]`` as UTF-8; ``bytes.split`` splits at exactly these six characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def plain_words(text: str | None) -> list[str]:
    """Lower-case runs of letters, digits and underscores: punctuation, case and layout do not count.

    Composed and decomposed accents are the same.
    """
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    return _LETTER_RUN.findall(text.lower())


def word_hashes(words: list[str] | list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word; the same in every process."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word."""
    h = (h ^ (h >> _SHIFT)) * _MIX_A
    h = (h ^ (h >> _SHIFT)) * _MIX_B
    return h ^ (h >> _SHIFT)


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` consecutive words, one per start; empty if there are fewer words."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = hashes[:n].copy()
    for j in range(1, length):
        h *= _STEP
        h += hashes[j:j + n]
    return mixed(h)

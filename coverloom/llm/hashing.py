"""Word and shingle hashes of whole texts, vectorised over the bytes of many texts at once."""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import numpy as np

SEGMENT = 1 << 20
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64


class WordRule:
    """What bytes separate words and which bytes count as equal."""

    def __init__(self, separators: bytes, fold_ascii: bool):
        self.separates = np.zeros(256, bool)
        self.separates[list(separators)] = True
        self.values = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        if fold_ascii:
            self.values[ord("A") : ord("Z") + 1] = self.values[ord("a") : ord("z") + 1]


# Words end at the six ASCII white-space characters; A-Z equals a-z.
BY_SPACE = WordRule(b" \t\n\v\f\r", True)
# Words are runs of ASCII letters, digits and bytes of other characters; give lower-cased text.
BY_PUNCTUATION = WordRule(bytes(b for b in range(128) if not re.match(r"[a-z0-9]", chr(b), re.I)), True)

# Scripts written without spaces between words; each of their characters counts as a word.
_UNSPACED = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029\u3031-\u303c"
    "\u3040-\u312f\u31a0-\u31ff\u3400-\u4dbf\u4e00-\ua4cf\ua9e0-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f"
    "\U0001aff0-\U0001b16f\U00020000-\U0003ffff]"
)


class _Spacing(dict):
    """What a character becomes, for str.translate; filled as characters come."""

    def __init__(self, keep_signs: bool):
        super().__init__()
        self.keep_signs = keep_signs

    def __missing__(self, code: int) -> str:
        c = chr(code)
        kind = unicodedata.category(c)
        if kind[0] == "Z" or kind == "Cc" or c in "\u200b\u2060\ufeff":
            found = " "
        elif kind[0] in "PS":
            found = f" {c} " if self.keep_signs else " "
        else:
            found = f" {c} " if _UNSPACED.match(c) else c
        self[code] = found
        return found


_WORDS, _WORDS_AND_SIGNS = _Spacing(False), _Spacing(True)
_ASCII_SIGN = re.compile(r"[!-/:-@\[-`{-~]")
_ASCII_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")


def plain_words(text: str) -> str:
    """Lower-cased text for ``BY_PUNCTUATION``: a space for every white space and sign of
    Unicode, and spaces around the characters of scripts without spaces."""
    text = text.lower()
    return text if text.isascii() else text.translate(_WORDS)


def words_and_signs(text: str) -> str:
    """Lower-cased text for ``BY_SPACE`` in which every sign is a word too."""
    text = text.lower()
    if text.isascii():
        return _ASCII_CONTROL.sub(" ", _ASCII_SIGN.sub(r" \g<0> ", text))
    return text.translate(_WORDS_AND_SIGNS)


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    found = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        found.append(np.multiply.accumulate(powers))
    return found[0], found[1]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``size`` of each."""
    return _powers(max(SEGMENT, 1 << max(size - 1, 1).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _segment_words(octets: np.ndarray, rule: WordRule) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of bytes that begin and end between words."""
    inside = ~rule.separates[octets]
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    starts, ends = edges[0::2], edges[1::2]
    up, down = powers(len(octets) + 1)
    sums = np.zeros(len(octets) + 1, np.uint64)
    np.cumsum(rule.values[octets] * up[: len(octets)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(texts: list[str], rule: WordRule) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of all texts in a row, and where each text begins (one more at the end).

    Works through segments of about a megabyte, cut between words, so that a long text costs
    its bytes and its hashes and no more.
    """
    octets = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([0, *(len(o) + 1 for o in octets)])
    joined = np.frombuffer(b"\n".join([*octets, b""]), np.uint8)
    starts, hashes, lo = [], [], 0
    while lo < len(joined):
        hi = min(lo + SEGMENT, len(joined))
        if hi < len(joined):
            reach = hi
            while True:
                gap = np.flatnonzero(rule.separates[joined[lo:reach]])
                if len(gap) or reach == len(joined):
                    break
                reach = min(reach + SEGMENT, len(joined))
            hi = lo + int(gap[-1]) + 1 if len(gap) else len(joined)
        start, found = _segment_words(joined[lo:hi], rule)
        starts.append(start + lo)
        hashes.append(found)
        lo = hi
    if not starts:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), np.cumsum(sizes))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words; none if there are fewer."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total += words[k : k + len(total)] * np.uint64((2 * k + 3) * 0xD6E8FEB86659FD93 & _MASK)
    return mix(total + np.uint64(size))


def signed(hashes: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return hashes.view(np.int64)

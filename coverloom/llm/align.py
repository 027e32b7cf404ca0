"""Alignment of two tokenizers over the same bytes, by an associative monoid of fragments.

Tokens of A (byte-level BPE) and of B (sentence pieces) cover the bytes of a space and the text.
Where a token of either ends at the same byte, both are cut into groups. A byte range of a
document yields a ``Fragment``: the tokens up to its first common end (open prefix), groups
closed inside it, and the tokens beyond its last common end (open suffix). ``compose`` puts two
neighbours together, closes the group between them if both hold a common end, and is
associative, so fragments of a very long document are reduced as a tree over Spark tasks; the
groups closed inside a fragment leave it at once, so what travels up the tree are open ends.

Both tokenizers start anew at a space or line break behind a character other than white space:
no piece of B holds a space behind another character or a line break (``Aligner`` checks its
vocabulary), and A's pre-tokenizer cuts there. The same holds between a Latin letter or digit and
an ASCII sign other than the apostrophe, where no piece of B holds the two. Such a stretch is a unit:
its tokens, groups and links are worked out once per task batch and worker and remembered. A
range of bytes may begin and end inside a unit, which is then tokenized in both ranges.

``parts`` gives the alignment itself: one row per document, or for documents of at least
``chunk_bytes`` one per range and one per group closed between ranges, with the groups as text
``a1,a2|b1;a3|b2,b3`` and the distinct linked id pairs with their number of occurrences.
``summary`` adds what needs the whole corpus: in how many documents a pair is linked. These
counts are a distributed table. Its most frequent rows, at most ``HOT_PAIRS``, go to every task;
all others meet the documents' rows in a join, so no count is left out and no row is hot in it.

Defined results: a null or empty text, and one whose joined A or B bytes are not a space and the
text (one that holds U+2581, say) has no tokens: zeros and no groups; strings of special
tokens are plain text; repeated rows are separate documents; an empty table gives an empty
result. Only the id and text columns are read.
"""

from __future__ import annotations

import gc
import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverloom.llm.common import settle, ship, text_of

CHUNK_BYTES = 1 << 16
# Fragments composed by one task in one step of the tree.
FAN_IN = 16
HOT_PAIRS = 1 << 20
# Units a worker remembers before it forgets those not seen again since, and the longest of them.
MOST_UNITS = 90_000
_LONG_UNIT = 48
_BATCH_CHARS = 1 << 20
# Pairs a task holds before it adds them up.
_TASK_PAIRS = 2_000_000
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
# Letters and digits, and the signs that may begin a unit behind them.
_LATIN = [c for c in map(chr, range(0x30, 0x180)) if c.isalnum() and (c.isascii() or c >= "\u00c0")]
_SIGNS = [c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'"]
_MARK = "\x01"
# White space other than spaces and line breaks, and the mark.
_OTHER_SPACE = "[\\x01\\t\\x0b\\x0c\\r\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
_NONE = np.empty(0, np.int64)
# Groups with more links are reduced to distinct ids before they are linked.
_LARGE_GROUP = 64


# ---- the monoid ----------------------------------------------------------------------


class Fragment(NamedTuple):
    """``cut``: a common end lies in the range. Without one, all tokens are in the prefix."""

    cut: bool
    before_a: np.ndarray
    before_b: np.ndarray
    after_a: np.ndarray
    after_b: np.ndarray


# The place before the first byte, where both tokenizers begin.
START = Fragment(True, _NONE, _NONE, _NONE, _NONE)
Group = tuple[np.ndarray, np.ndarray]


def compose(left: Fragment, right: Fragment) -> tuple[Fragment, Group | None]:
    """Both neighbours as one fragment, and the group that closes between them, if one does."""
    if not right.cut:
        if not left.cut:
            joined = (np.concatenate([left.before_a, right.before_a]), np.concatenate([left.before_b, right.before_b]))
            return Fragment(False, *joined, _NONE, _NONE), None
        return left._replace(after_a=np.concatenate([left.after_a, right.before_a]), after_b=np.concatenate([left.after_b, right.before_b])), None
    if not left.cut:
        return right._replace(before_a=np.concatenate([left.before_a, right.before_a]), before_b=np.concatenate([left.before_b, right.before_b])), None
    group = np.concatenate([left.after_a, right.before_a]), np.concatenate([left.after_b, right.before_b])
    found = Fragment(True, left.before_a, left.before_b, right.after_a, right.after_b)
    return found, group if len(group[0]) else None


class Closed(NamedTuple):
    """Groups in a row: the tokens of A and B and the group number of each."""

    a: np.ndarray
    a_group: np.ndarray
    b: np.ndarray
    b_group: np.ndarray
    groups: int


def grouped(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> tuple[Closed, Group]:
    """The groups that common ends cut from the left on, and the tokens beyond the last end."""
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    at_a, at_b = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
    in_a, in_b = at_a < len(common), at_b < len(common)
    return Closed(a[in_a], at_a[in_a], b[in_b], at_b[in_b], len(common)), (a[~in_a], b[~in_b])


def fragment(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> tuple[Fragment, Closed]:
    """The tokens that end in a byte range as a fragment, and the groups closed inside it."""
    found, rest = grouped(a, a_ends, b, b_ends)
    if not found.groups:
        return Fragment(False, a, b, _NONE, _NONE), found
    open_a, open_b = found.a_group == 0, found.b_group == 0
    closed = Closed(found.a[~open_a], found.a_group[~open_a] - 1, found.b[~open_b], found.b_group[~open_b] - 1, found.groups - 1)
    return Fragment(True, found.a[open_a], found.b[open_b], *rest), closed


class Described(NamedTuple):
    """Numbers, text, and linked pairs (A id above, B id in the lower 32 bits) with the times
    they occur; a pair may stand in several places."""

    n_groups: int
    n_links: int
    groups: str
    pairs: bytes
    times: bytes


# What follows a token in the text of the groups.
_NEXT, _SIDE, _GROUP = range(3)


@cache
def _words(size: int) -> list[str]:
    return [f"{i}{sign}" for i in range(size) for sign in ",|;"]


def _signs_of(c: Closed, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all groups in the order of their text, as id * 3 + what follows, and where
    each group begins."""
    begin, before_a, before_b = (np.cumsum(n) - n for n in (n_a + n_b, n_a, n_b))
    codes = np.empty(len(c.a) + len(c.b), np.int64)
    codes[np.arange(len(c.a)) + (begin - before_a)[c.a_group]] = c.a * 3
    codes[np.arange(len(c.b)) + (begin + n_a - before_b)[c.b_group]] = c.b * 3
    codes[begin + n_a - 1] += _SIDE
    codes[begin + n_a + n_b - 1] += _GROUP
    return codes, begin


def _pairs_of(c: Closed, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, pair and times of every A with every B of its group; of large groups, of every
    distinct one."""
    a, a_group, b, n = c.a, c.a_group, c.b, n_b
    times_a = times_b = None
    if len(n_a) and int((n_a * n_b).max()) > _LARGE_GROUP:
        some_a, times_a = np.unique((c.a_group << 32) | c.a, return_counts=True)
        some_b, times_b = np.unique((c.b_group << 32) | c.b, return_counts=True)
        a, a_group, b, n = some_a & 0xFFFFFFFF, some_a >> 32, some_b & 0xFFFFFFFF, np.bincount(some_b >> 32, minlength=c.groups)
    partners = n[a_group]
    left = np.repeat(np.arange(len(a)), partners)
    right = np.arange(len(left)) - np.repeat(np.cumsum(partners) - partners - (np.cumsum(n) - n)[a_group], partners)
    times = np.ones(len(left), np.int64) if times_a is None else times_a[left] * times_b[right]
    return a_group[left], (a[left] << 32) | b[right], times


def describe(c: Closed, owner: np.ndarray, owners: int) -> list[Described]:
    """What the groups of each owner hold; ``owner`` of the groups does not fall."""
    n_a, n_b = np.bincount(c.a_group, minlength=c.groups), np.bincount(c.b_group, minlength=c.groups)
    n_groups, n_links = np.bincount(owner, minlength=owners), np.zeros(owners, np.int64)
    np.add.at(n_links, owner, n_a * n_b)
    codes, begin = _signs_of(c, n_a, n_b)
    of, pairs, times = _pairs_of(c, n_a, n_b)
    places = np.arange(owners + 1)
    words, signs = _words(max(len(codes) and int(codes.max()) // 3 + 1, 1 << 16)), codes.tolist()
    cuts = np.append(begin, len(codes))[np.searchsorted(owner, places)].tolist()
    edges = np.searchsorted(owner[of], places).tolist()
    pairs, times, of_word = pairs.tobytes(), times.tobytes(), words.__getitem__
    return [
        Described(n, links, "".join(map(of_word, signs[x:y]))[:-1], pairs[8 * lo : 8 * hi], times[8 * lo : 8 * hi])
        for n, links, x, y, lo, hi in zip(n_groups.tolist(), n_links.tolist(), cuts, cuts[1:], edges, edges[1:], strict=False)
    ]


def summed(owner: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, pair) in order, with their times added up."""
    if not len(pairs):
        return _NONE, _NONE, _NONE
    order = np.lexsort((pairs, owner))
    owner, pairs, times = owner[order], pairs[order], times[order]
    new = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]) | (owner[1:] != owner[:-1])]))
    return owner[new], pairs[new], np.add.reduceat(times, new)


# ---- units ---------------------------------------------------------------------------


def units(text: str) -> list[str]:
    """A text that begins with a space or line break, cut where both tokenizers start anew."""
    return _CUT.split(text)


def sign_cut(held: set[tuple[str, str]]) -> str:
    """A pattern for a letter or digit and the sign after it, unless a piece holds the two."""
    behind: dict[str, str] = {}
    for sign in _SIGNS:
        letters = "".join(c for c in _LATIN if (c, sign) not in held)
        behind[letters] = behind.get(letters, "") + re.escape(sign)
    return "|".join(f"([{letters}])([{signs}])" for letters, signs in behind.items() if letters)


def coded_units(texts: list[str], cut: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct units of all texts (each with a space in front), the number of every unit in a
    row, and where each text begins (one more place at the end). Empty texts have none.

    Texts whose spaces and line breaks stand apart are split by Arrow, and at the signs that
    ``cut`` finds, the others by ``units``.
    """
    given = pa.array(texts, pa.string())
    plain = pc.invert(pc.match_substring_regex(given, _OTHER_SPACE))
    for mark in ("  ", " \n", "\n "):
        plain = pc.and_(plain, pc.invert(pc.match_substring(given, mark)))
    for edge in (pc.starts_with(given, " "), pc.ends_with(given, " "), pc.starts_with(given, "\n"), pc.equal(given, "")):
        plain = pc.and_(plain, pc.invert(edge))
    able = np.asarray(plain)
    lines = pc.replace_substring(given.filter(plain), "\n", " \n")
    while pc.any(pc.match_substring(lines, "\n \n")).as_py():  # line breaks in a row belong together
        lines = pc.replace_substring(lines, "\n \n", "\n\n")
    groups = 2 * (cut.count("|(") + 1)
    ends = "".join(f"\\{k}" for k in range(1, groups, 2)) + f" {_MARK}" + "".join(f"\\{k}" for k in range(2, groups + 1, 2))
    words = pc.split_pattern(pc.replace_substring_regex(lines, cut, ends), " ")
    coded = words.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    names = [w if w[:1] == "\n" else w[1:] if w[:1] == _MARK else " " + w for w in coded.dictionary.to_pylist()]
    codes, sizes = np.asarray(coded.indices).astype(np.int64), np.zeros(len(texts), np.int64)
    sizes[able] = np.asarray(pc.list_value_length(words))
    odd = {k: units(" " + texts[k]) for k in np.flatnonzero(~able).tolist() if texts[k]}
    if not odd:
        return names, codes, np.concatenate([[0], np.cumsum(sizes)])
    known = {name: k for k, name in enumerate(names)}
    stops, found = np.cumsum(sizes), []
    for k in range(len(texts)):
        if k in odd:
            sizes[k] = len(odd[k])
            found.append(np.array([known.setdefault(u, len(known)) for u in odd[k]], np.int64))
        elif able[k]:
            found.append(codes[stops[k] - sizes[k] : stops[k]])
    return list(known), np.concatenate([_NONE, *found]), np.concatenate([[0], np.cumsum(sizes)])


def _byte_of_sign() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and all others as 256 and up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Unit(NamedTuple):
    """``numbers``: whether it is wrong, tokens of A and of B, groups and links."""

    numbers: bytes
    described: Described


class Rows(NamedTuple):
    """Rows of ids, one behind the other."""

    flat: np.ndarray
    edges: np.ndarray

    @staticmethod
    def of(rows: list[list[int]]) -> Rows:
        edges = np.cumsum(np.fromiter(chain((0,), map(len, rows)), np.int64, len(rows) + 1))
        return Rows(np.fromiter(chain.from_iterable(rows), np.int64, int(edges[-1])), edges)

    def row(self, k: int) -> list[int]:
        return self.flat[self.edges[k] : self.edges[k + 1]].tolist()

    def sums(self, values: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(values[self.flat])])
        return run[self.edges[1:]] - run[self.edges[:-1]]


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the units seen."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        signs = _byte_of_sign()
        entries = {i: t for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.a_bytes = [bytes(signs[c] for c in entries.get(i, "")) for i in range(max(entries) + 1)]
        self.b = SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("\n" in p or "▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("pieces with inner spaces or line breaks cannot be aligned unit by unit")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(b) for b in found], np.int64) for found in (self.a_bytes, self.b_bytes))
        letters = [p for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        self.sign_cut = sign_cut({pair for p in letters for pair in zip(p, p[1:], strict=False)})
        self.b_space = [self.b.piece_to_id("▁")]
        self.known: dict[str, Unit] = {}
        self.older: dict[str, Unit] = {}

    def tokens(self, found: list[str]) -> tuple[Rows, Rows, np.ndarray]:
        """Ids of A and of B for each unit, and whether both give its bytes."""
        a = Rows.of([e.ids for e in self.a.encode_batch_fast(found, add_special_tokens=False)])
        # The processor puts a space in front, which is the unit's own, and the whole of a single
        # space; a line break keeps it apart as a piece, and is one itself.
        b = self.b.encode([u[1:] if u[0] == " " else u if u[0] == "\n" else "\n" + u for u in found], num_threads=1)
        b = Rows.of([(ids or self.b_space) if u[0] == " " else ids[1:] if u[0] == "\n" else ids[2:] for u, ids in zip(found, b, strict=True)])
        octets = [u.encode("utf-8", "surrogatepass") for u in found]
        size, whole = np.fromiter(map(len, octets), np.int64, len(octets)), b"".join(octets)
        same = (a.sums(self.a_size) == size) & (b.sums(self.b_size) == size)
        joined = [b"".join(map(of, ids.flat.tolist())) for of, ids in ((self.a_bytes.__getitem__, a), (self.b_bytes.__getitem__, b))]
        if same.all() and joined[0] == whole == joined[1]:
            return a, b, same
        right = [
            b"".join(map(self.a_bytes.__getitem__, a.row(k))) == octet == b"".join(map(self.b_bytes.__getitem__, b.row(k)))
            for k, octet in enumerate(octets)
        ]
        return a, b, np.array(right, bool)

    def align(self, found: list[str]) -> list[Unit]:
        """Units end at common ends, so all of them in a row are one text."""
        if not found:
            return []
        a, b, ok = self.tokens(found)
        n_a, n_b = np.diff(a.edges), np.diff(b.edges)
        ids_a, ids_b = (x.flat if ok.all() else x.flat[np.repeat(ok, n)] for x, n in ((a, n_a), (b, n_b)))
        closed, _ = grouped(ids_a, np.cumsum(self.a_size[ids_a]), ids_b, np.cumsum(self.b_size[ids_b]))
        first = np.flatnonzero(np.diff(closed.a_group, prepend=-1))
        described = describe(closed, np.searchsorted(np.cumsum(n_a[ok]), first, side="right"), int(ok.sum()))
        counts = np.array([(d.n_groups, d.n_links) for d in described], np.int64).reshape(-1, 2)
        numbers = np.column_stack([np.zeros(len(counts), np.int64), n_a[ok], n_b[ok], counts]).tobytes()
        right = iter([Unit(numbers[40 * k : 40 * k + 40], d) for k, d in enumerate(described)])
        return [next(right) if fine else _WRONG for fine in ok.tolist()]

    def learn(self, wanted: Iterable[str]) -> list[Unit]:
        """The units wanted, in order. Short ones are remembered; those that were not wanted
        again while ``MOST_UNITS`` others came are forgotten."""
        wanted = list(wanted)
        known, older = self.known, self.older
        new = [u for u in wanted if u not in known and u not in older]
        fresh = dict(zip(new, self.align(new), strict=True))
        found = [fresh.get(u) or known.get(u) or older[u] for u in wanted]
        known.update((u, unit) for u, unit in zip(wanted, found, strict=True) if len(u) <= _LONG_UNIT)
        if len(known) > MOST_UNITS:
            self.known, self.older = {}, known
        return found


_WRONG = Unit(np.array([1, 0, 0, 0, 0], np.int64).tobytes(), Described(0, 0, "", b"", b""))
_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(paths: tuple[str, str]) -> Aligner:
    if paths not in _aligners:
        _aligners[paths] = Aligner(*paths)
    return _aligners[paths]


class Part(NamedTuple):
    ok: bool
    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: str
    pairs: np.ndarray
    times: np.ndarray


_NO_PART = Part(False, 0, 0, 0, 0, "", _NONE, _NONE)


def align_units(aligner: Aligner, cut: list[list[str]]) -> list[Part]:
    """Each list of units as one part; all of them share what is looked up."""
    index = {u: k for k, u in enumerate(dict.fromkeys(chain.from_iterable(cut)))}
    rows = Rows.of([[index[u] for u in c] for c in cut])
    return _align_coded(aligner, list(index), *rows)


def align_texts(aligner: Aligner, texts: list[str]) -> list[Part]:
    """Whole texts, a space in front of each."""
    return _align_coded(aligner, *coded_units(texts, aligner.sign_cut))


def _align_coded(aligner: Aligner, names: list[str], codes: np.ndarray, edges: np.ndarray) -> list[Part]:
    """Rows of numbers of units as one part each."""
    known, rows = aligner.learn(names), len(edges) - 1
    if not known:
        return [_NO_PART._replace(ok=True) for _ in range(rows)]
    numbers = np.frombuffer(b"".join([u.numbers for u in known]), np.int64).reshape(-1, 5)
    run = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(numbers[codes], axis=0)])
    sums = run[edges[1:]] - run[edges[:-1]]
    owner = np.repeat(np.arange(rows), np.diff(edges))
    both, often = np.unique(owner * len(known) + codes, return_counts=True)
    of, unit = both // len(known), both % len(known)
    sizes = np.array([len(u.described.pairs) // 8 for u in known], np.int64)
    pairs, times = (np.frombuffer(b"".join(x), np.int64) for x in ([u.described.pairs for u in known], [u.described.times for u in known]))
    size, begin = sizes[unit], (np.cumsum(sizes) - sizes)[unit]
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
    of, pairs, times = summed(np.repeat(of, size), pairs[at], times[at] * np.repeat(often, size))
    places = np.searchsorted(of, np.arange(rows + 1))
    texts = pa.array([u.described.groups for u in known], pa.string()).take(pa.array(codes))
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), texts), ";").to_pylist()
    found = []
    for k, (wrong, n_a, n_b, n_groups, n_links) in enumerate(sums.tolist()):
        mine = slice(places[k], places[k + 1])
        found.append(_NO_PART if wrong else Part(True, n_a, n_b, n_groups, n_links, texts[k], pairs[mine], times[mine]))
    return found


# ---- byte ranges of long texts -------------------------------------------------------


def byte_ranges(text: str, size: int) -> Iterator[tuple[int, int, int, str]]:
    """lo, hi, start, piece: ranges of about ``size`` bytes of a space and the text, and the
    units that lie in each, which begin at byte ``start``. A bound inside a unit that already
    holds one is left out, so no unit is tokenized more than twice."""
    found = units(" " + text)
    ends = np.cumsum([len(u.encode("utf-8", "surrogatepass")) for u in found])
    starts = np.concatenate([[0], ends[:-1]])
    bounds, last = [0], -1
    for bound in range(size, int(ends[-1]), size):
        at = int(np.searchsorted(ends, bound))  # the unit that holds the bound or ends with it
        if at != last:
            bounds.append(bound)
        last = at
    bounds.append(int(ends[-1]))
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        first, stop = int(np.searchsorted(ends, lo, side="right")), int(np.searchsorted(starts, hi))
        yield lo, hi, int(starts[first]), "".join(found[first:stop])


def align_range(aligner: Aligner, lo: int, hi: int, start: int, piece: str) -> tuple[Fragment, Part]:
    """The tokens that end in (lo, hi], as a fragment and what is closed inside it."""
    whole = units(piece)
    edges = [whole[0], whole[-1]] if len(whole) > 1 else [whole[0]]
    a, b, ok = aligner.tokens(edges)
    inner = align_units(aligner, [whole[1:-1]])[0]
    if not (ok.all() and inner.ok):
        return START, _NO_PART
    last = start + sum(len(u.encode("utf-8", "surrogatepass")) for u in whole[:-1])
    state, parts, n_a, n_b = None, [], inner.n_a, inner.n_b
    for k, base in enumerate((start, last)[: len(edges)]):
        ids = []
        for found, sizes in ((a.row(k), aligner.a_size), (b.row(k), aligner.b_size)):
            found = np.array(found, np.int64)
            ends = base + np.cumsum(sizes[found])
            mine = (ends > lo) & (ends <= hi)
            ids += [found[mine], ends[mine]]
        n_a, n_b = n_a + len(ids[0]), n_b + len(ids[2])
        here, closed = fragment(*ids)
        between = []
        if state is None:
            state = here
        else:
            parts.append(inner)  # units in between end at common ends
            state, group = compose(state, here)
            between = [group] if group else []
        parts += [*_as_parts(between), _described_part(closed, closed.groups)]
    return state, joined(parts)._replace(n_a=n_a, n_b=n_b)


def _described_part(closed: Closed, groups: int) -> Part:
    (d,) = describe(closed, np.zeros(groups, np.int64), 1)
    return Part(True, 0, 0, d.n_groups, d.n_links, d.groups, np.frombuffer(d.pairs, np.int64), np.frombuffer(d.times, np.int64))


def _as_parts(groups: list[Group]) -> list[Part]:
    return [_described_part(Closed(a, np.zeros(len(a), np.int64), b, np.zeros(len(b), np.int64), 1), 1) for a, b in groups]


def joined(parts: list[Part]) -> Part:
    """Neighbouring parts as one."""
    pairs, times = np.concatenate([p.pairs for p in parts]), np.concatenate([p.times for p in parts])
    _, pairs, times = summed(np.zeros(len(pairs), np.int64), pairs, times)
    numbers = [sum(x) for x in zip(*(p[1:5] for p in parts), strict=True)]
    return Part(all(p.ok for p in parts), *numbers, ";".join(p.groups for p in parts if p.groups), pairs, times)


# ---- on Spark ------------------------------------------------------------------------

_PART = "ok boolean, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pairs array<bigint>, times array<bigint>"
_ENDS = "before_a array<bigint>, before_b array<bigint>, after_a array<bigint>, after_b array<bigint>"


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([_NONE, *arrays]), pa.int64()))


def _part_columns(found: list[Part]) -> list[pa.Array]:
    plain = [pa.array([p[k] for p in found], kind) for k, kind in enumerate((pa.bool_(), *[pa.int64()] * 4, pa.string()))]
    return [*plain, _lists([p.pairs for p in found]), _lists([p.times for p in found])]


_PART_NAMES = list(Part._fields)


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Rows in runs of about ``_BATCH_CHARS`` characters of text."""
    lo, held = 0, 0
    for k, size in enumerate(pc.utf8_length(batch.column(column)).to_pylist()):
        held += size
        if held >= _BATCH_CHARS:
            yield batch.slice(lo, k + 1 - lo)
            lo, held = k + 1, 0
    if lo < batch.num_rows:
        yield batch.slice(lo)


def _runs(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def _short_parts(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(paths)
        gc.disable()  # millions of units, no cycles
        for batch in batches:
            for some in _slices(batch, 2):
                found = align_texts(aligner, some.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([*some.columns[:2], *_part_columns(found)], ["key", "doc_id", *_PART_NAMES])
        gc.enable()

    return docs.mapInArrow(run, f"key bigint, doc_id {dict(docs.dtypes)['doc_id']}, {_PART}")


def _long_parts(docs: DataFrame, paths: tuple[str, str], chunk_bytes: int) -> DataFrame:
    """key, doc_id, position and part: ranges at even positions, groups closed between a range
    and those before it at the odd position before it."""
    kind = dict(docs.dtypes)["doc_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(batch.column(2)):
                found = list(byte_ranges(text.as_py(), chunk_bytes))
                columns = [pa.array([r[n] for r in found], t) for n, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
                same = pa.array([k] * len(found), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(same), batch.column(1).take(same), pa.array(np.arange(len(found))), *columns],
                    ["key", "doc_id", "chunk", "lo", "hi", "start", "piece"],
                )

    # Written before it is dealt out: keys and bounds are then the same in every attempt.
    pieces = settle(docs.mapInArrow(cut, f"key bigint, doc_id {kind}, chunk bigint, lo bigint, hi bigint, start bigint, piece string"), "align-pieces")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(paths)
        for some in _runs(batches, 16):
            fragments, found = [], []
            for chunk, *bounds, piece in zip(*(some.column(n).to_pylist() for n in range(2, 7)), strict=True):
                state, part = align_range(aligner, *bounds, piece)
                if chunk == 0:
                    state, group = compose(START, state)
                    first = _as_parts([group] if group else [])
                    part = joined([*first, part])._replace(n_a=part.n_a, n_b=part.n_b)
                fragments.append(state)
                found.append(part)
            ends = [_lists([f[n] for f in fragments]) for n in range(1, 5)]
            yield pa.RecordBatch.from_arrays(
                [*some.columns[:3], pa.array([f.cut for f in fragments], pa.bool_()), *ends, *_part_columns(found)],
                ["key", "doc_id", "chunk", "cut", *Fragment._fields[1:], *_PART_NAMES],
            )

    dealt = pieces.repartition("key", "chunk")
    ranges = settle(dealt.mapInArrow(run, f"key bigint, doc_id {kind}, chunk bigint, cut boolean, {_ENDS}, {_PART}"), "align-ranges")
    closed = ranges.select("key", "doc_id", (2 * F.col("chunk")).alias("position"), *_PART_NAMES)
    ends = ranges.select("key", "doc_id", "chunk", F.col("chunk").alias("first"), "cut", *Fragment._fields[1:])
    most = ranges.agg(F.max("chunk")).first()[0] or 0
    for _ in range(math.ceil(math.log(most + 1, FAN_IN)) if most else 0):
        step = settle(
            ends.groupBy("key", F.floor(F.col("chunk") / FAN_IN).cast("bigint").alias("node")).applyInArrow(
                _reduce, f"key bigint, doc_id {kind}, chunk bigint, first bigint, cut boolean, {_ENDS}, position bigint, {_PART}"
            ),
            "align-tree",
        )
        ends = step.filter("position is null").select(*ends.columns)
        closed = closed.unionByName(step.filter("position is not null").select(*closed.columns))
    return closed


def _reduce(fragments: pa.Table) -> pa.Table:
    """Up to ``FAN_IN`` neighbours as one fragment, and the groups that close between them.
    ``first`` is the range in which a fragment's first common end lies."""
    fragments = fragments.sort_by("chunk")
    rows = fragments.to_pylist()
    state, first, closed = None, None, []
    for row in rows:
        here = Fragment(row["cut"], *(np.array(row[n], np.int64) for n in Fragment._fields[1:]))
        if state is None:
            state, first = here, row["first"]
            continue
        if not state.cut and here.cut:
            first = row["first"]
        state, group = compose(state, here)
        if group:
            closed.append((2 * row["first"] - 1, *_as_parts([group])))
    parts = [_NO_PART._replace(ok=True), *(p for _, p in closed)]
    n = len(parts)
    only = [True, *[False] * len(closed)]
    ends = [_lists([state[k] if own else _NONE for own in only]) for k in range(1, 5)]
    same = pa.array([0] * n, pa.int32())
    columns = [
        fragments.column("key").combine_chunks().take(same), fragments.column("doc_id").combine_chunks().take(same),
        pa.array([rows[0]["chunk"] // FAN_IN] * n, pa.int64()), pa.array([first] * n, pa.int64()), pa.array([state.cut] * n, pa.bool_()),
        *ends, pa.array([None, *(p for p, _ in closed)], pa.int64()), *_part_columns(parts),
    ]
    return pa.Table.from_arrays(columns, ["key", "doc_id", "chunk", "first", "cut", *Fragment._fields[1:], "position", *_PART_NAMES])


def parts(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """The alignment of short documents, one row each, and of long ones, several rows each in
    the order of ``position``. ``key`` tells rows of the same id apart."""
    ship(docs.sparkSession)
    given = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", text_of().alias("text"))
    is_long = F.octet_length("text") >= chunk_bytes
    short = _short_parts(given.filter(~is_long), (a_path, b_path))
    return short, _long_parts(given.filter(is_long).withColumn("key", -1 - F.col("key")), (a_path, b_path), chunk_bytes)


def _whole(long: DataFrame) -> DataFrame:
    """Parts of long documents put together in a stream that is sorted by document and place:
    one row each, with the digest of the groups instead of their text."""
    kind = dict(long.dtypes)["doc_id"]
    dealt = long.repartition("key").sortWithinPartitions("key", "position")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = doc_id = digest = total = None

        def close() -> pa.RecordBatch:
            found = joined(total)
            if not found.ok:
                found = _NO_PART
            columns = _part_columns([found._replace(groups=digest.hexdigest() if found.n_groups else "")])
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), doc_id, *columns], ["key", "doc_id", *_PART_NAMES])

        for batch in _runs(batches, 16):
            for k, row in enumerate(batch.select(["key", *_PART_NAMES]).to_pylist()):
                if row["key"] != key:
                    if key is not None:
                        yield close()
                    key, doc_id, digest, total, begun = row["key"], batch.column("doc_id").slice(k, 1), hashlib.sha256(), [], False
                part = Part(*(row[n] for n in _PART_NAMES[:6]), np.array(row["pairs"], np.int64), np.array(row["times"], np.int64))
                if part.groups:
                    digest.update((";" if begun else "").encode() + part.groups.encode())
                    begun = True
                total.append(part._replace(groups=""))
                if len(total) == 64:
                    total = [joined(total)]
        if key is not None:
            yield close()

    return dealt.mapInArrow(run, f"key bigint, doc_id {kind}, {_PART}").withColumnRenamed("groups", "groups_sha256")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (documents that hold it linked), best (no pair of its A id has more). Every task
    adds up its pairs before they are dealt out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, counted = [], 0, (_NONE, _NONE)
        for batch in _runs(batches, 4096):
            found = np.asarray(batch.column(0).flatten())
            held.append(found)
            rows += len(found)
            if rows >= _TASK_PAIRS:
                counted, held, rows = _merged(held, counted), [], 0
                if len(counted[0]) >= _TASK_PAIRS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in counted], ["pair", "n"])
                    counted = (_NONE, _NONE)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _merged(held, counted)], ["pair", "n"])

    partial = aligned.select("pairs").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    return settle(partial.withColumn("best", F.col("n") == F.max("n").over(of_a)), "align-pairs")


def _merged(held: list[np.ndarray], counted: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    fresh = np.unique(np.concatenate([_NONE, *held]), return_counts=True)
    pairs, n = np.concatenate([counted[0], fresh[0]]), np.concatenate([counted[1], fresh[1]])
    _, pairs, n = summed(np.zeros(len(pairs), np.int64), pairs, n)
    return pairs, n


def _steps():
    """Counts in steps of a quarter of a power of two: a few hundred at most."""
    return F.floor(4 * F.log2("n") + 1e-9)


def summary(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int = CHUNK_BYTES, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    short, long = parts(docs, a_path, b_path, chunk_bytes)
    names = ["key", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    aligned = settle(short.withColumn("groups_sha256", digest).select(*names).unionByName(_whole(long).select(*names)), "aligned")
    counts = pair_counts(aligned)
    # As many of the steps with the highest counts as fit into the table that all tasks get.
    least, room = None, hot_pairs
    for step, n in sorted(((r.step, r.n) for r in counts.groupBy(_steps().alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True):
        if n > room:
            break
        least, room = step, room - n
    is_hot = F.lit(False) if least is None else _steps() >= least
    hot = counts.filter(is_hot).select("pair", "n", "best").toArrow()
    order = np.argsort(np.asarray(hot.column(0)))
    shared = docs.sparkSession.sparkContext.broadcast(tuple(np.asarray(c)[order] for c in hot.columns))

    def found_in(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = shared.value[0]
        at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
        return at, keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, n, best = shared.value
        for batch in _runs(batches, 1024):
            lists, times = batch.column(7), np.asarray(batch.column(8).flatten())
            at, known = found_in(np.asarray(lists.flatten()))
            edges = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))]).astype(np.int64)
            sums = []
            for value in (best, n):
                each = np.where(known, times * value[at], 0) if len(value) else np.zeros(len(at), np.int64)
                run = np.concatenate([[0], np.cumsum(each)]).astype(np.int64)
                sums.append(pa.array(run[edges[1:]] - run[edges[:-1]]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], *sums], [*names[:7], "n_best", "count_sum"])

    shown = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    kind = dict(docs.dtypes)["doc_id"]
    summed_up = aligned.select(*names).mapInArrow(
        add_up, f"key bigint, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint"
    )
    rest = counts.filter(~is_hot)
    if rest.isEmpty():
        return summed_up.select(*shown)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _runs(batches, 256):
            pairs, times = np.asarray(batch.column(1).flatten()), np.asarray(batch.column(2).flatten())
            mine = np.flatnonzero(~found_in(pairs)[1])
            owner = np.repeat(np.arange(batch.num_rows), np.asarray(batch.column(1).value_lengths()))[mine]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), pa.array(pairs[mine]), pa.array(times[mine])], ["key", "pair", "times"])

    rare = (
        aligned.select("key", "pairs", "times").mapInArrow(others, "key bigint, pair bigint, times bigint").join(rest, "pair")
        .groupBy("key").agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more"))
    )
    return (
        summed_up.join(rare, "key", "left")
        .withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more", F.lit(0))})
        .select(*shown)
    )

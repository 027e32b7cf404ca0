"""Licence scan by canonical digest lookup.

A text is made canonical line by line: lower case, hyphens dropped, equivalent spellings made
one, everything but letters and digits turned into one space, lines with a copyright notice
left out. The canonical text of a document is that of its lines, joined by spaces, so line
breaks do not matter. Digests of canonical texts are joined with those of known licences and
notices: of the entire document, of each of its lines, and of every run of lines that is as
long as some known text.

A digest is two 64-bit polynomial hashes of the characters. With running sums over a text, the
digest of any run of lines follows from its two ends, so a run costs the same however long it
is, and a line costs as many look-ups as known texts have different lengths. Texts are worked
through in windows of about a million characters that overlap by the longest known text.

Defined results: a null or empty text, or one of copyright lines only, matches nothing; known
texts that are canonically equal are one under the smallest name; repeated rows give a row
each; a line that is the whole document is found in both places, and so is a text with its
title line, which counts with the title and from the line after it; an empty table gives an
empty result. Only id and text columns are read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverloom.llm.common import ship, text_of
from coverloom.llm.hashing import mix, powers, signed
from coverloom.llm.license_texts import TEXTS

# Equivalent spellings as (pattern, replacement) on lower-cased text.
SPELLINGS = (
    (r"licen[cs]", "licens"),
    (r"acknowledge?ment", "acknowledgment"),
    (r"(fav|hon|behavi|endeav)our", "$1or"),
    (r"(author|organ|recogn|util)is", "$1iz"),
    (r"https", "http"),
    (r"whilst", "while"),
    (r"fulfil\b", "fulfill"),
    (r"per cent\b", "percent"),
)
# A notice: copyright followed by a sign, a year (or a place for one), or a name, or a name and
# then the years at the end of the line.
_COPYRIGHT = (
    r"^[^a-z0-9]*(copyright\s*(\(c\)|©|[0-9]|[<{\[]|by\b|holders?\s*:|the\b.*\b(authors|contributors|developers|team|project|foundation)\b)"
    r"|copyright\s+[^0-9]{1,80}\s(19|20)[0-9][0-9][-,\s0-9]*[.]?\s*(all rights reserved[.]?)?\s*$"
    r"|\(c\)\s*[0-9]|©|all rights reserved)"
)
_WINDOW, _WINDOW_LINES = 1 << 20, 1 << 13

# Texts of public licences and common one-line notices.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_KNOWN = (
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.\n\n" + _AS_IS,
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_AS_IS,
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.\n\n" + _ISC_AS_IS,
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This project is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\n\n"
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
    "a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\n"
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
    "interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the "
    "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all "
    "present and future rights to this software under copyright law.\n\n" + _AS_IS.replace("OR COPYRIGHT HOLDERS ", "") +
    "\n\nFor more information, please refer to <http://unlicense.org/>"
)
_BSD_CLAUSES = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.",
)
_BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
    "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED "
    "OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
_TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("0BSD", "BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License'),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License'),
    "Unlicense": ("The Unlicense", "Unlicense"),
}


def _full_texts() -> tuple[tuple[str, str], ...]:
    """Full texts with and without title lines, numbers of clauses and what follows the terms."""
    found = []
    for n in (2, 3):
        for marks in ("123", "***"):
            clauses = "".join(f"{m} {c}\n" for m, c in zip(marks, _BSD_CLAUSES[:n], strict=False))
            found.append((f"BSD-{n}-Clause", _BSD_HEAD + clauses + _BSD_AS_IS))
    found.append(("Unlicense", _UNLICENSE))
    found += [(name, f"{title}\n{text}") for name, text in (*_KNOWN[:3], *found) for title in _TITLES[name]]
    for name, titles, text in TEXTS:
        lines = text.strip().split("\n")
        body = [k for k, line in enumerate(lines) if line.strip()][titles]
        last = next((k for k, line in enumerate(lines) if line.strip() == "END OF TERMS AND CONDITIONS"), len(lines))
        found += [(name, "\n".join(lines[first:end])) for first in (0, body) for end in sorted({last, last + 1, len(lines)}) if end <= len(lines)]
    return tuple(found)


KNOWN = _KNOWN + _full_texts()


# ---- canonical lines and digests -----------------------------------------------------

_SPELLINGS = [(re.compile(pattern, re.A), one.replace("$1", r"\1")) for pattern, one in SPELLINGS]
_NOTICE = re.compile(_COPYRIGHT, re.A)


class _Letters(dict):
    """What a character becomes, for str.translate: a space unless it is a letter or a digit."""

    def __missing__(self, code: int) -> str:
        found = chr(code) if code == 10 or unicodedata.category(chr(code))[0] in "LN" else " "
        self[code] = found
        return found


_LETTERS = _Letters()


def canonical_lines(text: str) -> list[str]:
    """The canonical form of every line, empty for a copyright line."""
    lower = text.lower()
    words = lower.replace("-", "")
    for pattern, one in _SPELLINGS:
        words = pattern.sub(one, words)
    lines = [" ".join(line.split()) for line in words.translate(_LETTERS).split("\n")]
    if "copyright" in lower or "(c)" in lower or "©" in lower or "all rights reserved" in lower:
        lines = ["" if line and _NOTICE.search(given) else line for line, given in zip(lines, lower.split("\n"), strict=True)]
    return lines


def _digests(text: str, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of the characters from each start to each end."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    up, down = powers(len(codes) + 1)
    found = []
    for salt in (0x51ED270B, 0x2545F491):
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mix(codes + np.uint64(salt << 21)) * up[: len(codes)], out=sums[1:])
        found.append(signed(mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))))
    return found[0], found[1]


def runs_of(docs: list[list[str]], lengths: np.ndarray, window: int = _WINDOW) -> tuple[np.ndarray, ...]:
    """doc, position and both hashes of every run of lines whose length is one of ``lengths``:
    position 0 for a whole document, else the line it begins at. A whole document of several
    lines counts as such only."""
    kept = [(d, k + 1, line) for d, lines in enumerate(docs) for k, line in enumerate(lines) if line]
    if not kept or not len(lengths):
        return tuple(np.empty(0, np.int64) for _ in range(4))
    doc = np.array([k[0] for k in kept], np.int64)
    position = np.array([k[1] for k in kept], np.int64)
    size = np.array([len(k[2]) for k in kept], np.int64)
    stop = np.cumsum(size + 1) - 1
    start = stop - size
    first = np.concatenate([[True], doc[1:] != doc[:-1]])
    last = np.concatenate([first[1:], [True]])
    out, lo, most = [], 0, int(lengths.max())
    while lo < len(kept):
        hi = min(max(int(np.searchsorted(start, start[lo] + window)), lo + 1), lo + _WINDOW_LINES)
        reach = max(int(np.searchsorted(start, start[hi - 1] + most, side="right")), hi)
        base, begin, end = start[lo], start[lo:hi], stop[lo:reach]
        # For each length the runs that begin at a line here and end with a line of the same document.
        wanted = begin[:, None] + lengths[None, :]
        at = np.minimum(np.searchsorted(end, wanted), len(end) - 1)
        row, column = np.nonzero((end[at] == wanted) & (doc[lo:hi, None] == doc[lo:reach][at]))
        if len(row):
            ending = lo + at[row, column]
            beginning = lo + row
            text = " ".join(k[2] for k in kept[lo : int(ending.max()) + 1])
            h1, h2 = _digests(text, start[beginning] - base, stop[ending] - base)
            whole = first[beginning] & last[ending]
            several = beginning != ending
            out.append((doc[beginning], np.where(whole & several, 0, position[beginning]), h1, h2))
            single = whole & ~several  # found as the document and as its line
            out.append((doc[beginning][single], np.zeros(int(single.sum()), np.int64), h1[single], h2[single]))
        lo = hi
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else tuple(np.empty(0, np.int64) for _ in range(4))


# ---- on Spark ------------------------------------------------------------------------


def _known_digests(known: DataFrame) -> DataFrame:
    """license, length and both hashes of every known text; equal ones under the smallest name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [" ".join(filter(None, canonical_lines(t))) for t in batch.column(1).to_pylist()]
            found = [(name, len(t), *(int(h[0]) for h in _digests(t, np.array([0]), np.array([len(t)])))) for name, t in zip(batch.column(0).to_pylist(), texts, strict=True) if t]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)], ["license", "length", "h1", "h2"])

    rows = known.select("license", text_of().alias("text")).mapInArrow(run, "license string, length bigint, h1 bigint, h2 bigint")
    return rows.groupBy("length", "h1", "h2").agg(F.min("license").alias("license"))


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(KNOWN), "license string, text string")


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, license, position of every known text: an entire document (0), or what begins at
    a line and ends with that line or a later one."""
    spark = ship(docs.sparkSession)
    digests = _known_digests(known)
    # Whole numbers, at most as many as the longest known text has characters.
    lengths = spark.sparkContext.broadcast(np.array(sorted(r.length for r in digests.select("length").distinct().collect()), np.int64))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo, held = 0, []
            for k, text in enumerate(batch.column(1)):
                held.append(canonical_lines(text.as_py()))
                if sum(map(len, held[-1])) > _WINDOW or len(held) == 256 or k == batch.num_rows - 1:
                    doc, position, h1, h2 = runs_of(held, lengths.value)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc + lo)), pa.array(position), pa.array(h1), pa.array(h2)], ["doc_id", "position", "h1", "h2"])
                    lo, held = k + 1, []

    found = docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, position bigint, h1 bigint, h2 bigint")
    return found.join(digests, ["h1", "h2"]).select("doc_id", "license", "position")

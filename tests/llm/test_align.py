import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from coverloom.llm import align, queries
from coverloom.llm.common import table

from conftest import TESTDATA

DOCS = "doc_id bigint, text string, pairs string, key string"
SHOWN = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
PATHS = queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def aligner():
    return align.Aligner(*PATHS)


def plain_groups(aligner, text):
    """Groups of ids from encoding the whole text with both tokenizers."""
    if not text:
        return []
    a, b = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)
    left, right = [aligner.a_bytes[i] for i in a], [aligner.b_bytes[i] for i in b]
    if not b"".join(left) == b"".join(right) == (" " + text).encode():
        return []
    found, i, j, at_a, at_b, mine = [], 0, 0, 0, 0, ([], [])
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            at_a += len(left[i])
            mine[0].append(a[i])
            i += 1
        else:
            at_b += len(right[j])
            mine[1].append(b[j])
            j += 1
        if at_a == at_b:
            found.append(mine)
            mine = ([], [])
    return found


def as_text(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def plain(aligner, docs):
    every = [plain_groups(aligner, t) for _, t in docs]
    links = [Counter((a, b) for left, right in groups for a in left for b in right) for groups in every]
    counts = Counter(pair for found in links for pair in found)
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    return sorted(
        (
            (
                i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(found.values()),
                sum(n for p, n in found.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in found.items()),
                hashlib.sha256(as_text(g).encode()).hexdigest() if g else "",
            )
            for (i, _), g, found in zip(docs, every, links, strict=True)
        ),
        key=repr,
    )


def found(frame):
    assert frame.columns == SHOWN
    return sorted((tuple(r) for r in frame.collect()), key=repr)


PIECES = ["a", "the", "Straße", " ", "  ", "\n", "\r\n", "\t", "don't", "x" * 30, "1234567", "==", "中文字", "🙂", "<|endoftext|>", "<s>", " ", "é", "\x00", "\x1c", " \n", "▁", "...", "　", "t.", "St.", "x,y;z", "it's.", "ü!", "(a)", "\x01", "1.5%"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14))
def test_units_equal_whole_texts(aligner, pieces):
    text = "".join(pieces)
    part, other = align.align_texts(aligner, [text, "another text"])
    groups = plain_groups(aligner, text)
    assert part.groups == as_text(groups) and other.groups == as_text(plain_groups(aligner, "another text"))
    assert not text or align.align_units(aligner, [align.units(" " + text)])[0].groups == part.groups
    links = Counter((a << 32) | b for left, right in groups for a in left for b in right)
    assert dict(zip(part.pairs.tolist(), part.times.tolist(), strict=True)) == links
    assert (part.n_a, part.n_b, part.n_groups, part.n_links) == (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(links.values()))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PIECES[:17]), min_size=1, max_size=20), st.integers(1, 9), st.randoms(use_true_random=False))
def test_any_tree_over_byte_ranges_gives_the_groups(aligner, pieces, size, pick):
    text = "".join(pieces)
    row = [align.align_range(aligner, *r) for r in align.byte_ranges(text, size)]
    row = [(align.START, []), *[(state, [part.groups] if part.groups else []) for state, part in row]]
    while len(row) > 1:  # any two neighbours, in any order
        k = pick.randrange(len(row) - 1)
        (x, left), (y, right) = row[k : k + 2]
        state, group = align.compose(x, y)
        row[k : k + 2] = [(state, [*left, *([as_text([group])] if group else []), *right])]
    (state, texts), = row
    assert ";".join(texts) == as_text(plain_groups(aligner, text))
    assert state.cut and not len(state.after_a) and not len(state.after_b)


def test_ranges_cover_the_text_and_leave_out_inner_bounds():
    ranges = list(align.byte_ranges("ab " * 100 + "x" * 95 + " cd" * 20, 10))
    assert ranges[0][0] == 0 and all(x[1] == y[0] for x, y in zip(ranges, ranges[1:], strict=False))
    assert sum("x" * 95 in r[3] for r in ranges) <= 2


def test_query_equals_brute_force(spark, aligner):
    docs = [(r.doc_id, r.text) for r in table(spark, TESTDATA, "documents").collect()]
    assert found(queries.op13_tokenizer_alignment(spark, TESTDATA)) == plain(aligner, docs)


@pytest.mark.parametrize("hot", [0, 200, 1 << 20])
def test_long_and_odd_texts(spark, aligner, hot, monkeypatch):
    pick = np.random.default_rng(4)
    words = ["the", "Straße", "don't", "中文字", "x=1;", "\n", "a\nb", "  ", "1234567", "hello", "🙂"]
    long = [" ".join(pick.choice(words, 3000)) for _ in range(3)]
    texts = [None, "", " ", "same text", "same text", "a ▁ b", "<|endoftext|> <s> </s>", "中文" * 2000, "\n".join(map(str, range(3000))), " " * 3000, "z" * 3000, *long, long[0], long[1] + "▁"]
    docs = [*enumerate(texts), (None, "null id"), (3, "same text")]
    frame = spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS)
    monkeypatch.setattr(align, "_BATCH_CHARS", 3000)
    assert found(align.summary(frame, *PATHS, chunk_bytes=128, hot_pairs=hot)) == plain(aligner, docs)


def test_empty_table(spark):
    assert found(align.summary(spark.createDataFrame([], DOCS), *PATHS)) == []

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from coverloom.llm import token_files

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(texts):
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_word_encoder_equals_the_tokenizer():
    parts = ["a", "B", "é", "1", " ", "  ", "\n", " \n", "\t", ".", "...", "'s", "!!", "-", "_", "́", "中", "😀", "<|endoftext|>", "it's", "\x85"]
    pick = random.Random(3)
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 14))) for _ in range(5000)]
    encoder = token_files.WordEncoder(PATH)
    found = [np.frombuffer(b, "<u4").tolist() for lo in range(0, 5000, 100) for b in encoder.encode(texts[lo : lo + 100])]
    assert found == ids_of(texts)


def test_words_of_letters_go_to_the_model_directly(monkeypatch):
    parts = ["the", "ñandú", "Straße", "ʯǅ", "ÿÀ", "×", "÷", "ʰ", "ა", "9", "'s", "it's", ".", "),", "_", " ", " ", "\n", "ªº", "µ"]
    pick = random.Random(5)
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 12))) for _ in range(4000)]
    encoder, asked = token_files.WordEncoder(PATH), []
    ask = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda words: asked.extend(words) or ask(words))
    found = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    assert found == ids_of(texts)
    asked.clear()
    plain = [f"new{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]} words, only." for k in range(100)]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(plain)] == ids_of(plain)
    assert not [w for w in asked if any(c.isalpha() for c in w)]


def test_many_unspaced_lines():
    lines = [f"{k}.5\tw{k % 977}!" for k in range(100_000)]
    texts = ["\n".join(lines), "a b " + "\n".join(lines[:5000]) + "\n\nend\nend", "行\n" * 3000, "x\r\n" * 3000 + "y\nz"]
    encoder = token_files.WordEncoder(PATH)
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == ids_of(texts)
    encoder.encode(["next"])
    assert max(map(len, [*encoder.first, *encoder.spaced])) <= 1000  # no text and no rest of one is kept


def test_words_are_worked_out_when_first_met(monkeypatch):
    monkeypatch.setattr(token_files, "MOST_WORDS", 50)
    encoder = token_files.WordEncoder(PATH)
    for k in range(4):  # over the limit, words are forgotten and worked out again
        texts = [" ".join(f"w{j % 90}, Wort{j}ä." for j in range(n, n + 60)) for n in range(k, 300, 7)] + ["x" * 3000 + " " + "y1\n" * 1000]
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == ids_of(texts)
        assert max(map(len, [*encoder.first, *encoder.spaced])) <= 1000


@pytest.mark.parametrize("bits", [1, 8])
@pytest.mark.parametrize("ids", [[], [0], [2**32 - 1, 0, 7], list(range(300)) * 5, [50256] * 1000])
def test_blocks_round_trip(bits, ids):
    packed = token_files.pack_block(np.array(ids, "<u4"), bits)
    assert token_files.unpack_block(packed).tolist() == ids


def test_crcs_of_pieces_join():
    data = bytes(range(256)) * 9
    for cuts in ([0, 5, 5, 2304], [0, 2304], [0, 1, 700, 2304]):
        parts = [(b - a, zlib.crc32(data[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)]
        assert token_files.join_crcs(parts) == zlib.crc32(data)


def test_documents_come_back_from_the_files(spark):
    given = [(k, ("word " * (k * 3 % 50)) + f"end {k}", "x") for k in range(60, 0, -1)]
    given += [(None, "no id", "x"), (70, None, "x"), (71, "", "x"), (72, "same", "x"), (72, "same", "x"), (73, "long " * 5000, "x")]
    files = token_files.write_tokens(spark.createDataFrame(given, "doc_id bigint, text string, shard string"), PATH, block_ids=64)
    found = sorted(map(tuple, token_files.read_documents(files).collect()), key=lambda r: r[1])
    order = sorted(given, key=lambda g: (g[0] is not None, g[0] or 0))
    expected, at = [], 0
    for (doc_id, *_), ids in zip(order, ids_of([g[1] or "" for g in order]), strict=True):
        whole = np.array([*ids, 2], "<u4")
        expected.append((doc_id, at, len(whole), zlib.crc32(whole.tobytes())))
        at += len(whole)
    assert found == expected
    blocks = token_files.read_ids(files).orderBy("shard", "block").collect()
    assert sum(len(b.ids) for b in blocks) == at and all(len(b.ids) <= 64 for b in blocks)


def test_empty_table(spark):
    files = token_files.write_tokens(spark.createDataFrame([], "doc_id bigint, text string"), PATH)
    assert token_files.read_documents(files).count() == 0

"""Token ids as bit-plane-shuffled, compressed blocks, written and read by Spark.

Documents are range-partitioned and sorted by id; each task is one shard. Its stream of ids is
cut into blocks of a fixed number of ids. A block is taken apart into planes: plane k holds
byte k (or bit k) of every id, lowest first, and planes above the largest id are left out.
Every plane is compressed with zstandard on its own.

One row of the table is one block, and its columns are the index:
  shard, block   place of the block, ``start``: ids of the shard before it, ``n_ids``
  planes         b"BPL1", u32 n_ids, u8 bits per plane (8 or 1), u8 number of planes,
                 u32 length of each plane, then the zstandard frames; little-endian
  pieces         the documents in the block: ordinal in the shard, piece number, ids here
Spark's own writer stores the rows, so files appear when their task has committed, in any
store Spark can write, and a lost executor leaves nothing half-written.

Defined results: a null or empty text has the end id only; null ids come first; documents of
one id are ordered by a hash of their text, and rows that agree in both are interchangeable;
an empty table gives an empty file table.
"""

from __future__ import annotations

import codecs
import gc
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverloom.llm.common import settle, ship, text_of

END_ID = 2
BLOCK_IDS = 65_536
# Distinct words a worker remembers before it forgets the long ones.
MOST_WORDS = 700_000
_SHORT_WORD = 8
# Words of more characters (lists, tables, texts without spaces) are not remembered.
_LONG_WORD = 1_000
_MAGIC = b"BPL1"
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"
_BLOCKS_A_BATCH = 8
# How byte-level tokenizers write bytes: printing characters of Latin-1 as they are, the others
# from U+0100 on.
_PRINTING = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [b for b in range(256) if b not in _PRINTING]
_BYTE_SIGNS = "".join(chr(b if b in _PRINTING else 256 + _OTHERS.index(b)) for b in range(256))

_PIECE = "struct<ordinal: bigint, doc_id: bigint, piece: int, n: int>"
FILE_SCHEMA = f"shard int, block bigint, start bigint, n_ids int, planes binary, pieces array<{_PIECE}>"


# ---- blocks --------------------------------------------------------------------------


def pack_block(ids: np.ndarray, bits: int = 8, level: int = 3) -> bytes:
    """A block of ids as compressed byte planes (``bits=8``) or bit planes (``bits=1``)."""
    octets = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    width = int(ids.max()).bit_length() if len(ids) else 0
    if bits == 8:
        planes = [octets[:, k] for k in range(-(-width // 8))]
    else:
        rows = np.unpackbits(octets, axis=1, bitorder="little")
        planes = [np.packbits(rows[:, k], bitorder="little") for k in range(width)]
    pack = zstandard.ZstdCompressor(level=level)
    frames = [pack.compress(np.ascontiguousarray(p).tobytes()) for p in planes]
    head = _MAGIC + struct.pack("<IBB", len(ids), bits, len(frames))
    return head + struct.pack(f"<{len(frames)}I", *map(len, frames)) + b"".join(frames)


def unpack_block(block: bytes) -> np.ndarray:
    if block[:4] != _MAGIC:
        raise ValueError("not a block of token ids")
    n, bits, planes = struct.unpack_from("<IBB", block, 4)
    sizes = struct.unpack_from(f"<{planes}I", block, 10)
    octets, at = np.zeros((n, 4), np.uint8), 10 + 4 * planes
    rows = np.zeros((n, 32), np.uint8) if bits == 1 else None
    unpack = zstandard.ZstdDecompressor()
    for k, size in enumerate(sizes):
        plane = np.frombuffer(unpack.decompress(block[at : at + size]), np.uint8)
        at += size
        if rows is None:
            octets[:, k] = plane
        else:
            rows[:, k] = np.unpackbits(plane, bitorder="little")[:n]
    if rows is not None:
        octets = np.packbits(rows, axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view("<u4").reshape(-1)


# ---- encoding ------------------------------------------------------------------------


class _Known(dict):
    """The ids of words that follow ``lead``, a space or nothing, worked out when first asked for."""

    def __init__(self, encoder: WordEncoder, lead: str):
        super().__init__()
        self.encoder, self.lead = encoder, lead

    def __missing__(self, word: str) -> bytes:
        ids = self.encoder.work_out(word, self)
        if len(word) <= _LONG_WORD:
            self[word] = ids
        return ids

    def trim(self) -> None:
        """Short words are the frequent ones; they stay when there are too many."""
        if len(self) > MOST_WORDS:
            short = {w: ids for w, ids in self.items() if len(w) <= _SHORT_WORD}
            self.clear()
            self.update(short if len(short) <= MOST_WORDS // 2 else {})


class WordEncoder:
    """The tokenizer's ids for whole texts, asking it once per distinct word.

    Byte-level pre-tokenising starts a new piece at every space that has no white space on
    both sides, whatever comes before, so the ids of a text are those of its space-led words
    in a row. Texts with a space between white space, and texts that hold an added token,
    are given to the tokenizer whole. A word of Latin letters is one piece of pre-tokenizing,
    so it goes to the tokenizer's model directly, its bytes written as byte-level signs.
    """

    _inside = re.compile(r"\s \s")
    _break = re.compile(r"(?<=\S)\n(?=\S)")
    _letters = re.compile(rf"([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u02af]+)([{re.escape(_SIGNS)}]*)")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        kinds = [type(p).__name__ for p in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer, self.model)]
        self.direct = kinds == ["NoneType", "ByteLevel", "BPE"]
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.first, self.spaced = _Known(self, ""), _Known(self, " ")

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _ids_of_letters(self, text: str) -> bytes:
        """The same for a text that is one piece."""
        if not self.direct:
            return self._ids([text])[0]
        signs, _ = codecs.charmap_decode(text.encode(), "strict", _BYTE_SIGNS)
        return array("I", [t.id for t in self.model.tokenize(signs)]).tobytes()

    def work_out(self, word: str, known: _Known) -> bytes:
        """Signs after a letter or digit, a line break between other characters and what follows
        them are pieces of their own, so most new words are put together from known parts. A
        word is split at all its line breaks at once."""
        if found := self._letters.fullmatch(word):
            stem, signs = found.groups()
            return known[stem] + self.first[signs] if signs else self._ids_of_letters(known.lead + word)
        if "\n" in word:
            lines = self._break.split(word)
            if len(lines) > 1:
                first = self.first
                feed = first["\n"]
                return known[lines[0]] + feed + feed.join([first[x] for x in lines[1:]])
        else:
            stem = word.rstrip(_SIGNS)
            if len(stem) < len(word) and stem and stem[-1].isalnum():
                return known[stem] + self.first[word[len(stem) :]]
        return self._ids([known.lead + word])[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        first, spaced = self.first, self.spaced
        first.trim()
        spaced.trim()
        whole = [bool(self._inside.search(t)) or any(a in t for a in self.added) for t in texts]
        rest = iter(self._ids([t for t, odd in zip(texts, whole, strict=True) if odd]))
        found = []
        for text, odd in zip(texts, whole, strict=True):
            if odd:
                found.append(next(rest))
            else:
                head, *words = text.split(" ")
                found.append(first[head] + b"".join(map(spaced.__getitem__, words)))
        return found


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _write_shard(batches: Iterator[pa.RecordBatch], path: str, end_id: int, block_ids: int, bits: int) -> Iterator[pa.RecordBatch]:
    shard, encoder = TaskContext.get().partitionId(), _encoder(path)
    gc.disable()  # millions of words, no cycles
    end = np.array([end_id], "<u4").tobytes()
    held, room = [], block_ids
    pieces: list[dict] = []
    out: list[dict] = []
    blocks = ordinal = 0

    def close() -> None:
        nonlocal held, room, pieces, blocks
        ids = np.frombuffer(b"".join(held), "<u4")
        out.append({
            "shard": shard, "block": blocks, "start": blocks * block_ids, "n_ids": len(ids),
            "planes": pack_block(ids, bits), "pieces": pieces,
        })
        held, room, pieces, blocks = [], block_ids, [], blocks + 1

    def sent() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pylist(out, schema=_ARROW)
        out.clear()
        return batch

    for batch in batches:
        ids_of, texts = batch.column(0).to_pylist(), batch.column(1)
        for lo in range(0, len(ids_of), 512):
            for doc_id, ids in zip(ids_of[lo : lo + 512], encoder.encode(texts.slice(lo, 512).to_pylist()), strict=True):
                left, piece = memoryview(ids + end), 0
                while left:
                    here = left[: 4 * room]
                    held.append(here)
                    pieces.append({"ordinal": ordinal, "doc_id": doc_id, "piece": piece, "n": len(here) // 4})
                    room, piece, left = room - len(here) // 4, piece + 1, left[len(here) :]
                    if not room:
                        close()
                        if len(out) == _BLOCKS_A_BATCH:
                            yield sent()
                ordinal += 1
    if held:
        close()
    if out:
        yield sent()
    gc.enable()


_ARROW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int64()), ("start", pa.int64()), ("n_ids", pa.int32()), ("planes", pa.binary()),
    ("pieces", pa.list_(pa.struct([
        ("ordinal", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("n", pa.int32()),
    ]))),
])


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS, bits: int = 8) -> DataFrame:
    """Encode doc_id and text into the file table described above and return that table,
    read from its files."""
    ship(docs.sparkSession)
    tie = F.xxhash64(text_of())
    ordered = (
        docs.select("doc_id", text_of().alias("text"), tie.alias("tie"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("tie"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
        .select("doc_id", "text")
    )
    return settle(ordered.mapInArrow(lambda it: _write_shard(it, tokenizer, end_id, block_ids, bits), FILE_SCHEMA), "token-files")


# ---- reading -------------------------------------------------------------------------


def _read_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            octets, at = memoryview(unpack_block(row["planes"]).tobytes()), 0
            for p in row["pieces"]:
                size = 4 * p["n"]
                crc = zlib.crc32(octets[at : at + size])
                rows.append((row["shard"], p["ordinal"], p["doc_id"], row["start"] + at // 4, p["piece"], p["n"], crc))
                at += size
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PIECE_TYPES, strict=True)], _PIECE_NAMES)


_PIECE_NAMES = ["shard", "ordinal", "doc_id", "start", "piece", "n", "crc"]
_PIECE_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]


def join_crcs(parts: list[tuple[int, int]]) -> int:
    """crc32 of a sequence from (bytes, crc32) of its pieces: going over n bytes changes the
    running value as n zero bytes would, and the bytes' own crc32 is added."""
    total = 0
    for k, (size, crc) in enumerate(parts):
        zeros = b"\0" * size if k else b""
        total = crc if not k else zlib.crc32(zeros, total) ^ zlib.crc32(zeros) ^ crc
    return total


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crcs = [join_crcs([(4 * p["n"], p["crc"]) for p in parts]) for parts in batch.column(4).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(crcs, pa.int64())], [*batch.schema.names[:4], "ids_crc32"])


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the file table."""
    ship(files.sparkSession)
    pieces = files.select("shard", "start", "planes", "pieces").mapInArrow(
        _read_pieces, "shard int, ordinal bigint, doc_id bigint, start bigint, piece int, n int, crc bigint"
    )
    documents = pieces.groupBy("shard", "ordinal", "doc_id").agg(
        F.min("start").alias("start"), F.sum("n").cast("long").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("piece", "n", "crc"))).alias("parts"),
    )
    joined = documents.select("shard", "doc_id", "start", "n_tokens", "parts").mapInArrow(
        _join_pieces, "shard int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
    # One row per shard.
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.groupBy("shard").agg(F.sum("n_ids").alias("ids")).select("shard", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    return joined.join(bases, "shard").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(files: DataFrame) -> DataFrame:
    """shard, block, start, ids: the decoded blocks."""

    ship(files.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [unpack_block(b.as_py()).astype(np.int64) for b in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ids, pa.list_(pa.int64()))], ["shard", "block", "start", "ids"])

    return files.select("shard", "block", "start", "planes").mapInArrow(decode, "shard int, block bigint, start bigint, ids array<bigint>")

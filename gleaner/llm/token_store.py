"""Token ids in binary shards, with a minimal perfect hash index over the documents.

Layout under one folder:

* ``shard-000000.ids``: the raw ids of the shard's documents, little-endian, two
  bytes each while the vocabulary and the end id allow it, else four;
* ``shard-000000.off``: 64-bit id positions, one per document and one for the end;
* ``bucket-000000.mph``: an index bucket (below).

Documents lie in ascending doc_id order across the shards (null first).  Each
bucket of about ``BUCKET_KEYS`` keys holds a minimal perfect hash function: levels
of bit arrays, in which a key's place is set if no other key of its level
falls there; the rank of that bit is the key's slot.  A slot stores a 32-bit
fingerprint (which turns away keys that were never stored), shard, first row
and number of rows, so access by key takes a fixed number of reads: bucket,
slot, offsets, payload.

Encoding runs the tokenizers library on whole texts.  For vocabularies whose
words never cross white space, every distinct word is encoded once per worker (in a
cache of bounded size) and the ids are joined; texts with characters for which that
is not certain are encoded in one piece.

Defined cases: a null or empty text has only the end id.  Rows that share a doc_id are
stored one after the other and found together, in the order of their texts.  A null
doc_id is a key like any other.  Whole texts are encoded, whatever their length; an
empty table gives empty shards and no buckets.  Extra columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, mix64, scratch, stored, tasks_for
from .files import make_folder, opened, written

END_ID = 2
CACHE_WORDS = 600_000
LONGEST_CACHED = 64
BUCKET_KEYS = 50_000
LEVEL_SLOTS = 2.0
#: Stands for a null doc_id among the keys.
NULL_KEY = -(1 << 63)
_MAGIC = b"GLMPH001"
#: ASCII information separators: white space to Python, not to the tokenizers library.
_UNSURE = re.compile("[\x1c-\x1f]")
#: Words of printable ASCII and Latin-1 letters, which no normalization changes but lower-casing.
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: How a vocabulary with word ends splits such a word, lower-cased.
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
#: Byte-level vocabularies write a byte as the Latin-1 character of its number if that is printable, and the
#: others, in order, from U+0100 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTES = {b: 0x100 + k for k, b in enumerate(b for b in range(0x100) if b not in _PRINTABLE)}


class Encoder:
    """Text -> packed ids, one per Python worker and tokenizer file."""

    _known: dict[str, Encoder] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._known:
            cls._known[path] = cls(path)
        return cls._known[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            setup = json.load(f)
        self.width = 2 if max(self.tokenizer.get_vocab_size(with_added_tokens=True), END_ID + 1) <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        split = json.dumps([setup["normalizer"], setup["pre_tokenizer"]])
        self.by_word = setup["model"]["type"] == "BPE" and setup["model"].get("end_of_word_suffix") == "</w>" and all(
            x in split for x in ('"NFC"', '"Lowercase"', r"[^\\s\\p{L}\\p{N}]+", r"'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]"))
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.kind).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        if not _PLAIN.fullmatch(word) or "<|" in word:
            return self._whole(word)
        out, model = [], self.tokenizer.model
        for piece in _PIECES.findall(word.lower()):
            got = self.pieces.get(piece)
            if got is None:
                if len(self.pieces) >= CACHE_WORDS:
                    self.pieces.clear()
                got = self.pieces[piece] = self._pack([t.id for t in model.tokenize(piece.encode().decode("latin-1").translate(_BYTES))])
            out.append(got)
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [self._pack(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        parts = [None if _UNSURE.search(t) else t.split() for t in texts]
        need = set(chain.from_iterable(p for p in parts if p is not None))
        if len(self.words) + len(need) > CACHE_WORDS:
            self.words.clear()
        words = self.words
        for w in need.difference(words):
            words[w] = self._word(w)
        out = [self._whole(t) if p is None else b"".join(map(words.__getitem__, p)) for t, p in zip(texts, parts)]
        for w in need:
            if len(w) > LONGEST_CACHED:
                del words[w]
        return out


# ---------------------------------------------------------------- shards

def write_shards(documents: DataFrame, folder: str, tokenizer_path: str, shards: int | None = None) -> DataFrame:
    """Write the shards; (key, shard, row, first_id, n_tokens) of every document, to be stored before use."""
    make_folder(folder)
    end = END_ID

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = Encoder.of(tokenizer_path), TaskContext.get().partitionId()
        tail, at, row = np.array([end], dtype=encoder.kind).tobytes(), 0, 0
        with written(f"{folder}/shard-{shard:06d}.ids") as ids, written(f"{folder}/shard-{shard:06d}.off") as off:
            for batch in chunks(batches, "text"):
                packed = encoder.encode([t or "" for t in batch.column("text").to_pylist()])
                sizes = np.array([len(p) // encoder.width + 1 for p in packed], dtype=np.int64)
                first = at + np.cumsum(sizes) - sizes
                off.write(first.astype("<u8").tobytes())
                for p in packed:
                    ids.write(p)
                    ids.write(tail)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), pa.array(np.full(len(sizes), shard, np.int32)), pa.array(row + np.arange(len(sizes))),
                     pa.array(first), pa.array(sizes), pa.array(np.full(len(sizes), encoder.width, np.int32))],
                    names=["key", "shard", "row", "first_id", "n_tokens", "width"])
                at, row = at + int(sizes.sum()), row + len(sizes)
            off.write(np.array([at], dtype="<u8").tobytes())

    keyed = documents.select(_key(F.col("doc_id")).alias("key"), "text")
    # equal keys lie in one range, so that their order by text holds within a shard
    return (keyed.repartitionByRange(shards or tasks_for(documents), "key").sortWithinPartitions("key", "text")
            .mapInArrow(run, "key long, shard int, row long, first_id long, n_tokens long, width int"))


def _key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NULL_KEY))


def shard_starts(rows: DataFrame) -> DataFrame:
    """(shard, base): ids in all shards before; one row per shard."""
    sizes = rows.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))


# ---------------------------------------------------------------- index

def _slot_hash(keys: np.ndarray, level: int) -> np.ndarray:
    return mix64(keys.view(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))


class PerfectHash:
    """A minimal perfect hash function with stored fingerprints over distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray], prints: np.ndarray):
        self.levels, self.prints = levels, prints  # levels: boolean arrays
        self.ranks, total = [], 0
        for bits in levels:
            self.ranks.append(total + np.cumsum(bits) - bits)
            total += int(bits.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, rest = [], keys
        while len(rest):
            size = max(64, int(LEVEL_SLOTS * len(rest)))
            at = (_slot_hash(rest, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            rest = rest[~alone[at]]
        out = cls(levels, np.zeros(len(keys), dtype="<u4"))
        slots, _ = out._place(keys)
        out.prints[slots] = out.fingerprints(keys)
        return out

    @staticmethod
    def fingerprints(keys: np.ndarray) -> np.ndarray:
        return (mix64(keys.view(np.uint64) ^ np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)).astype("<u4")

    def _place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slots, todo = np.zeros(len(keys), dtype=np.int64), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            at = (_slot_hash(keys[todo], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            slots[todo[hit]] = ranks[at[hit]]
            todo = todo[~hit]
        found = np.ones(len(keys), dtype=bool)
        found[todo] = False
        return slots, found

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for keys that were never stored (but for one foreign key in 2^32)."""
        if not len(self.prints):
            return np.full(len(keys), -1)
        slots, found = self._place(keys)
        return np.where(found & (self.prints[slots] == self.fingerprints(keys)), slots, -1)

    def dump(self) -> bytes:
        head = np.array([len(self.prints), len(self.levels), *map(len, self.levels)], dtype="<u8").tobytes()
        return _MAGIC + head + b"".join(np.packbits(b).tobytes() for b in self.levels) + self.prints.tobytes()

    @classmethod
    def load(cls, data: bytes) -> tuple[PerfectHash, int]:
        """The function and how many bytes it took."""
        if data[:8] != _MAGIC:
            raise ValueError("not an index bucket")
        n, depth = (int(x) for x in np.frombuffer(data, "<u8", 2, 8))
        sizes = np.frombuffer(data, "<u8", depth, 24).astype(int)
        at, levels = 24 + 8 * depth, []
        for size in sizes:
            packed = np.frombuffer(data, np.uint8, -(-size // 8), at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        return cls(levels, np.frombuffer(data, "<u4", n, at)), at + 4 * n


_ENTRY = np.dtype([("shard", "<u4"), ("row", "<u8"), ("copies", "<u4")])


def write_index(rows: DataFrame, folder: str, bucket_keys: int = BUCKET_KEYS) -> tuple[DataFrame, int]:
    """Write one file per bucket of keys; returns (bucket, keys) of each, and the number of buckets."""
    make_folder(folder)
    entries = rows.groupBy("key").agg(F.min("shard").alias("shard"), F.min("row").alias("row"), F.count("*").cast("int").alias("copies"))
    buckets = max(1, -(-rows.count() // bucket_keys))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        keys = frame["key"].to_numpy(dtype=np.int64)
        function = PerfectHash.build(keys)
        table = np.zeros(len(keys), dtype=_ENTRY)
        slots = function.find(keys)
        for name in _ENTRY.names:
            table[name][slots] = frame[name].to_numpy()
        bucket = int(frame["bucket"].iloc[0])
        with written(f"{folder}/bucket-{bucket:06d}.mph") as out:
            out.write(function.dump())
            out.write(table.tobytes())
        return pd.DataFrame({"bucket": [bucket], "n_keys": [len(keys)]})

    return (entries.withColumn("bucket", _bucket(F.col("key"), buckets)).groupBy("bucket")
            .applyInPandas(build, "bucket int, n_keys long")), buckets


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def lookup(keys: DataFrame, folder: str, buckets: int) -> DataFrame:
    """(key, shard, row, copies) of the given ``key`` column, from the index files; keys never stored are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, function, table = None, None, None
        for batch in batches:
            own, keys_ = batch.column("bucket").to_numpy(), batch.column("key").to_numpy()
            for part in np.split(np.arange(len(own)), np.flatnonzero(np.diff(own)) + 1):
                if not len(part):
                    continue
                if own[part[0]] != at:
                    at = own[part[0]]
                    with opened(f"{folder}/bucket-{at:06d}.mph") as file:
                        data = file.read()
                    function, used = PerfectHash.load(data)
                    table = np.frombuffer(data, _ENTRY, len(function.prints), used)
                slots = function.find(keys_[part])
                hit = table[slots[slots >= 0]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys_[part][slots >= 0]), pa.array(hit["shard"].astype(np.int32)), pa.array(hit["row"].astype(np.int64)),
                     pa.array(hit["copies"].astype(np.int32))], names=["key", "shard", "row", "copies"])

    return (keys.select("key", _bucket(F.col("key"), buckets).alias("bucket")).repartition(max(1, min(buckets, tasks_for(keys))), "bucket")
            .sortWithinPartitions("bucket", "key").mapInArrow(run, "key long, shard int, row long, copies int"))


def read_rows(found: DataFrame, folder: str, width: int) -> DataFrame:
    """(key, shard, first_id, n_tokens, ids_crc32) of the found rows, from the shard files.

    The checksum is over the ids as little-endian unsigned 32-bit integers.
    Rows of one shard are read in order, each by its own range.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, off = None, None, None
        try:
            for batch in batches:
                shards, rows = batch.column("shard").to_pylist(), batch.column("row").to_pylist()
                first, size, crc = [], [], []
                for shard, row in zip(shards, rows):
                    if shard != at:
                        for f in (ids, off):
                            if f is not None:
                                f.close()
                        at, ids, off = shard, opened(f"{folder}/shard-{shard:06d}.ids"), opened(f"{folder}/shard-{shard:06d}.off")
                    lo, hi = (int(x) for x in np.frombuffer(off.read_at(16, 8 * row), "<u8"))
                    got = np.frombuffer(ids.read_at((hi - lo) * width, lo * width), f"<u{width}")
                    first.append(lo)
                    size.append(len(got))
                    crc.append(zlib.crc32(got.astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), batch.column("shard"), pa.array(first, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                    names=["key", "shard", "first_id", "n_tokens", "ids_crc32"])
        finally:
            for f in (ids, off):
                if f is not None:
                    f.close()

    each = found.select("key", "shard", F.explode(F.expr("sequence(row, row + copies - 1)")).alias("row"))
    return (each.repartition(tasks_for(found), "shard").sortWithinPartitions("shard", "row")
            .mapInArrow(run, "key long, shard int, first_id long, n_tokens long, ids_crc32 long"))


def store(documents: DataFrame, folder: str, tokenizer_path: str) -> tuple[DataFrame, int]:
    """Shards and index of the documents; the stored row table and the number of buckets."""
    rows = stored(write_shards(documents, folder, tokenizer_path), "token-rows")
    index, buckets = write_index(rows, folder)
    stored(index, "token-index")
    return rows, buckets


def round_trip(documents: DataFrame, tokenizer_path: str, folder: str | None = None) -> DataFrame:
    """Write shards and index, then find every document by its key and read its ids back.

    One row per document: doc_id, start (ids before it), n_tokens, ids_crc32.
    """
    folder = folder or scratch(documents.sparkSession, "tokens")
    rows, buckets = store(documents, folder, tokenizer_path)
    width = rows.agg(F.max("width")).first()[0] or 2
    keys = documents.select(_key(F.col("doc_id")).alias("key")).distinct()
    read = read_rows(lookup(keys, folder, buckets), folder, width)
    return (read.join(shard_starts(rows), "shard")
            .select(F.when(F.col("key") != NULL_KEY, F.col("key")).alias("doc_id"), (F.col("base") + F.col("first_id")).alias("start"),
                    "n_tokens", "ids_crc32"))

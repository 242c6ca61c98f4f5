"""Token ids in raw binary shards with a minimal perfect hash index for keyed access.

A store is a folder in shared storage:

* `shard-PPPPPP-SSSS.bin`: ids as little-endian unsigned integers (16 bits where the
  vocabulary allows it, else 32), documents in ascending key order, an end id after each;
* `shard-PPPPPP-SSSS.idx`: minimal perfect hash over the shard's keys (a pilot per
  bucket), and per slot a 32-bit fingerprint of the key, the first document under it and
  their number, then the offset of every document;
* `routing/` and `shards/`: Parquet tables, key -> shard, and shard -> ids before it.

A key is found in constant time: hash, pilot, slot, fingerprint, offset. Shards are
bounded, so a task holds one shard whatever the size of the corpus, and a task that runs
again writes the same files again under the same names.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from switchflow.llm.common import partitions, whole_text
from switchflow.llm.tokens import id_encoder, vocabulary

SHARD_IDS = 16_000_000  # ids after which a shard is closed
BATCH = 2048  # documents encoded at once
PER_BUCKET = 4
MAGIC = b"TOKIDX01"
HEAD = struct.Struct("<8sQQQQ")  # magic, width, documents, keys, buckets
ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * ODD
    return x ^ (x >> np.uint64(29))


def _hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each key the 64 bits that place it and the 32-bit fingerprint."""
    place = np.fromiter((xxhash.xxh64_intdigest(k, 1) for k in keys), dtype="<u8", count=len(keys))
    mark = np.fromiter((xxhash.xxh32_intdigest(k, 2) for k in keys), dtype="<u4", count=len(keys))
    return place, mark


def _slots(place: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    return (_mix(place ^ _mix(pilots * ODD + ODD)) % np.uint64(n)).astype(np.int64)


def build_pilots(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pilot per bucket, slot per key) of a minimal perfect hash; large buckets are placed first."""
    n = len(place)
    buckets = max(1, -(-n // PER_BUCKET))
    pilots, slots, taken = np.zeros(buckets, "<u4"), np.zeros(n, np.int64), np.zeros(n, bool)
    bucket = (place >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
    for b in np.argsort(ends[:-1] - ends[1:], kind="stable"):
        own = order[ends[b] : ends[b + 1]]
        if not len(own):
            break
        first, step = 0, 64
        while True:
            tries = np.arange(first, first + step, dtype=np.uint64)
            at = _slots(place[own][None, :], tries[:, None], n)
            good = ~taken[at].any(axis=1)
            if len(own) > 1:
                ranked = np.sort(at, axis=1)
                good &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if good.any():
                hit = int(np.argmax(good))
                pilots[b], slots[own] = first + hit, at[hit]
                taken[at[hit]] = True
                break
            first, step = first + step, min(step * 2, 1 << 14)
            if first > 1 << 31:
                raise RuntimeError("two keys of a shard have the same hash")
    return pilots, slots


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), os.path.abspath(uri))


def _put(folder: str, name: str, data: bytes) -> None:
    """Write under another name first, so that a reader never meets half a file."""
    fs, path = _filesystem(folder)
    task = TaskContext.get()
    part = f"{path}/_{name}.{task.taskAttemptId() if task else 0}"
    with fs.open_output_stream(part) as f:
        f.write(data)
    fs.move(part, f"{path}/{name}")


def index_bytes(keys: list[bytes], ends: np.ndarray, width: int) -> bytes:
    """Index of a shard. keys: of its documents, ascending, repeats adjacent; ends: ids up to the end of each."""
    firsts = [i for i, k in enumerate(keys) if i == 0 or k != keys[i - 1]]
    counts = np.diff([*firsts, len(keys)]).astype("<u4")
    place, mark = _hashes([keys[i] for i in firsts])
    pilots, slots = build_pilots(place)
    cells = np.zeros((len(firsts), 3), "<u4")
    cells[slots] = np.stack([mark, np.array(firsts, "<u4"), counts], axis=1)
    offsets = np.concatenate(([0], ends)).astype("<u8")
    return HEAD.pack(MAGIC, width, len(keys), len(firsts), len(pilots)) + pilots.tobytes() + cells.tobytes() + offsets.tobytes()


class ShardIndex:
    """The parsed index of one shard."""

    def __init__(self, data: bytes):
        magic, self.width, docs, self.keys, buckets = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not an index of token ids")
        at = HEAD.size
        self.pilots = np.frombuffer(data, "<u4", buckets, at)
        self.cells = np.frombuffer(data, "<u4", 3 * self.keys, at + 4 * buckets).reshape(-1, 3)
        self.offsets = np.frombuffer(data, "<u8", docs + 1, at + 4 * buckets + 12 * self.keys)

    def find(self, keys: list[bytes]) -> list[tuple[int, int]]:
        """(first document, documents) for each key; no documents where the fingerprint says that the key is not in the shard."""
        place, mark = _hashes(keys)
        pilots = self.pilots[((place >> np.uint64(32)) % np.uint64(len(self.pilots))).astype(np.int64)]
        cells = self.cells[_slots(place, pilots.astype(np.uint64), self.keys)]
        return [(int(c[1]), int(c[2])) if c[0] == m else (0, 0) for c, m in zip(cells, mark, strict=True)]


def _key(value) -> bytes:
    return b"\0" if value is None else str(value).encode()


def _shards(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int, width: int) -> Iterator[tuple[str, list, int]]:
    """Write the shards of one task; (name, keys, ids) of each."""
    encode = id_encoder(tokenizer)
    end = np.array([end_id], "<u4").tobytes()
    part, seq = TaskContext.get().partitionId(), 0
    keys, ends, payload, total = [], [], [], 0

    def close():
        name = f"shard-{part:06d}-{seq:04d}"
        _put(folder, f"{name}.bin", b"".join(payload))
        _put(folder, f"{name}.idx", index_bytes([_key(k) for k in keys], np.array(ends, dtype="<u8"), width))
        return name, keys, total

    for b in batches:
        for at in range(0, b.num_rows, BATCH):
            piece = b.slice(at, BATCH)
            for key, ids in zip(piece.column(0).to_pylist(), encode(piece.column(1).to_pylist()), strict=True):
                # documents under one key stay in one shard
                if total >= SHARD_IDS and key != keys[-1]:
                    yield close()
                    seq, keys, ends, payload, total = seq + 1, [], [], [], 0
                raw = np.frombuffer(ids + end, "<u4")
                payload.append(raw.astype(f"<u{width}").tobytes())
                total += len(raw)
                keys.append(key)
                ends.append(total)
    if keys:
        yield close()


@dataclass
class TokenStore:
    """A written store."""

    spark: SparkSession
    path: str

    @property
    def shards(self) -> DataFrame:
        """(shard, n_docs, n_ids, base): base counts the ids of all shards before."""
        return self.spark.read.parquet(f"{self.path}/shards")

    @property
    def routing(self) -> DataFrame:
        """(key, shard), a row for each distinct key."""
        return self.spark.read.parquet(f"{self.path}/routing")

    def lookup(self, keys: DataFrame, with_ids: bool = True) -> DataFrame:
        """(key, start, n_tokens, ids_crc32[, ids]) of the documents under the distinct values of the first column of keys.

        ids are little-endian unsigned 32-bit integers with the end id. A key that is
        not in the store gives no row, a key with several documents one row for each.
        """
        folder = self.path

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            name, wanted, base = None, [], 0

            def found():
                fs, path = _filesystem(folder)
                with fs.open_input_file(f"{path}/{name}.idx") as f:
                    index = ShardIndex(f.read())
                rows = []
                with fs.open_input_file(f"{path}/{name}.bin") as f:
                    for key, (first, n) in zip(wanted, index.find([_key(k) for k in wanted]), strict=True):
                        for doc in range(first, first + n):
                            lo, hi = int(index.offsets[doc]), int(index.offsets[doc + 1])
                            raw = f.read_at((hi - lo) * index.width, lo * index.width)
                            ids = np.frombuffer(raw, f"<u{index.width}").astype("<u4").tobytes()
                            rows.append((key, base + lo, hi - lo, zlib.crc32(ids), *([ids] if with_ids else [])))
                        if len(rows) >= 1000:
                            yield from out(rows)
                            rows = []
                yield from out(rows)

            def out(rows):
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=False)], names=names)

            types = None
            for b in batches:
                types = types or [b.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                for key, shard, before in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
                    if shard != name and wanted:
                        yield from found()
                        wanted = []
                    name, base = shard, before
                    wanted.append(key)
            if wanted:
                yield from found()

        kind = self.routing.schema["key"].dataType.simpleString()
        names = ["key", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
        asked = keys.select(F.col(keys.columns[0]).alias("asked")).distinct()
        route = self.routing.join(asked, F.col("key").eqNullSafe(F.col("asked")), "left_semi")
        plan = route.join(self.shards.select("shard", "base"), "shard").select("key", "shard", "base")
        dealt = plan.repartition(partitions(self.spark), "shard").sortWithinPartitions("shard")
        return dealt.mapInArrow(run, f"key {kind}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text", width: int = 2) -> TokenStore:
    """Encode every whole text and write the store. Other columns of docs are not read.

    Null texts are empty: they hold the end id alone. Documents with equal ids stay
    together, by text; a null id is a key of its own and comes first. An empty table
    makes a store without shards. `width` is the bytes per id; 2 needs ids below 65,536.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or vocabulary("byte_bpe_50k.json")
    kind = docs.schema[id_column].dataType.simpleString()
    fs, folder = _filesystem(path)
    fs.create_dir(folder, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_type = None

        def kept():
            nonlocal key_type
            for b in batches:
                key_type = b.schema.field(0).type
                yield b

        for name, keys, total in _shards(kept(), path, tokenizer, end_id, width):
            n = len(keys)
            sizes = [total, *[0] * (n - 1)]  # the shard's ids are told by its first row
            yield pa.RecordBatch.from_arrays([pa.array(keys, key_type), pa.array([name] * n), pa.array(sizes, pa.int64())], names=["key", "shard", "n_ids"])

    lean = docs.select(F.col(id_column).alias("key"), whole_text(text_column).alias("text"))
    dealt = lean.repartitionByRange(partitions(spark), "key").sortWithinPartitions("key", "text")
    dealt.mapInArrow(run, f"key {kind}, shard string, n_ids long").write.parquet(f"{path}/written")
    written = spark.read.parquet(f"{path}/written")
    written.select("key", "shard").distinct().write.parquet(f"{path}/routing")
    totals = written.groupBy("shard").agg(F.count("*").alias("n_docs"), F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard, not per document
    totals.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).write.parquet(f"{path}/shards")
    return TokenStore(spark, path)

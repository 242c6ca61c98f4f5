"""Best-fit packing of documents into bins of a fixed number of tokens.

Open bins are ordered by the room they have left and carry a bitmap of the sources and
duplicate clusters they hold. A document goes to the tightest bin that has room and
shares neither with it; the search goes on from one residual to the next until such a
bin is found. Bitmaps are kept for ranges of residuals too (the bits that every bin of
the range has), so a search passes over thousands of bins of a hot source at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchflow.llm.common import whole_text
from switchflow.llm.tokens import tiktoken_encoding, vocabulary
from switchflow.session import materialize

CAPACITY = 2048
SHARD_ROWS = 8192  # rows packed together; more rows make more shards, not larger ones


class Bins:
    """Open bins by residual. The tree holds, per range of residuals, the AND of the bins' bitmaps; -1 where there are none."""

    def __init__(self, capacity: int):
        self.capacity, self.count = capacity, 0
        self.width = 1 << capacity.bit_length()
        self.tree = [-1] * (2 * self.width)
        self.at: list[dict[int, list[int]]] = [{} for _ in range(self.width)]  # residual -> bitmap -> bins

    def _renew(self, residual: int) -> None:
        common = -1
        for bitmap in self.at[residual]:
            common &= bitmap
        i = residual + self.width
        self.tree[i] = common
        while i > 1:
            i >>= 1
            both = self.tree[2 * i] & self.tree[2 * i + 1]
            if self.tree[i] == both:
                break
            self.tree[i] = both

    def _open(self, i: int, conflicts: int) -> bool:
        # -1 has every bit, so an empty range never fits a document with a conflict bit
        return self.tree[i] != -1 and not self.tree[i] & conflicts

    def _first(self, i: int, lo: int, hi: int, size: int, conflicts: int) -> tuple[int, int] | None:
        """(residual, bitmap) of the tightest compatible bin below node i, which spans residuals lo to hi - 1."""
        if hi <= size or not self._open(i, conflicts):
            return None
        if hi - lo == 1:
            return next(((lo, b) for b in self.at[lo] if not b & conflicts), None)
        mid = (lo + hi) // 2
        return self._first(2 * i, lo, mid, size, conflicts) or self._first(2 * i + 1, mid, hi, size, conflicts)

    def put(self, size: int, conflicts: int) -> tuple[int, int]:
        """(bin, offset) for a document."""
        found = self._first(1, 0, self.width, size, conflicts)
        if found:
            residual, bitmap = found
            bins = self.at[residual][bitmap]
            name = bins.pop()
            if not bins:
                del self.at[residual][bitmap]
                self._renew(residual)
        else:
            residual, bitmap, name = self.capacity, 0, self.count
            self.count += 1
        left = residual - size
        if left:
            own = self.at[left].setdefault(bitmap | conflicts, [])
            own.append(name)
            if len(own) == 1:
                self._renew(left)
        return name, self.capacity - residual


def _bits(*columns: list) -> list[int]:
    """For each row the bits of its values that occur more than once in their column; null has none."""
    out, used = [0] * len(columns[0]), 0
    for values in columns:
        counts = pd.Series(values).value_counts(dropna=True)
        bit = {v: 1 << (used + i) for i, v in enumerate(counts.index[counts > 1])}
        used += len(bit)
        out = [o | bit.get(v, 0) for o, v in zip(out, values, strict=True)]
    return out


def pack_shard(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """rows (id, n_tokens, source, cluster, rank) -> (id, piece, bin, offset, n_tokens); largest rows first, then by rank."""
    rows = rows.assign(last=(rows["n_tokens"] - 1) % capacity + 1).sort_values(["last", "rank"], ascending=[False, True], kind="stable")
    bits = _bits(rows["source"].tolist(), rows["cluster"].tolist())
    bins, out = Bins(capacity), []
    for key, n, last, conflicts in zip(rows["id"], rows["n_tokens"], rows["last"], bits, strict=True):
        full = (n - last) // capacity
        for piece in range(full):
            out.append((key, piece, bins.count, 0, capacity))
            bins.count += 1
        name, offset = bins.put(int(last), conflicts)
        out.append((key, full, name, offset, last))
    return pd.DataFrame(out, columns=["id", "piece", "bin", "offset", "n_tokens"])


def with_lengths(docs: DataFrame, tokens: str | None = None, text_column: str = "text") -> DataFrame:
    """(doc_id, source, cluster, n_tokens): tokens of the whole text and an end token.

    cluster is the same for texts that differ in white space and the case of A-Z only.
    Empty and null texts have the end token alone and no cluster.
    """
    path = tokens or vocabulary("byte_bpe_50k.tiktoken")
    id_type, source_type = (docs.schema[c].dataType.simpleString() for c in ("doc_id", "source"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tiktoken_encoding(path).encode_ordinary
        for b in batches:
            texts = b.column(2).to_pylist()
            plain = [b" ".join(t.encode().lower().split()) for t in texts]
            cluster = [xxhash.xxh3_64_intdigest(p) - (1 << 63) if p else None for p in plain]
            n = [len(encode(t)) + 1 for t in texts]
            cols = [*b.columns[:2], pa.array(cluster, pa.int64()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "source", "cluster", "n_tokens"])

    lean = docs.select("doc_id", "source", whole_text(text_column).alias("text"))
    return lean.mapInArrow(run, f"doc_id {id_type}, source {source_type}, cluster long, n_tokens long")


def pack(rows: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """rows (doc_id, source, cluster, n_tokens) -> (doc_id, piece, bin, offset, n_tokens).

    No bin holds two documents of one source or one cluster; a null source or cluster is
    at odds with none. Every row is placed: one longer than a bin is cut into pieces of
    `capacity` tokens that fill bins of their own, and its rest is packed. Rows with
    equal or null ids are rows like others. n_tokens must be 1 or more. An empty table
    gives an empty result. Shards follow the rows, not the machines, so the
    result is the same on any cluster.
    """
    held = materialize(rows.select("doc_id", "source", "cluster", "n_tokens"), "pack")
    shards = max(1, -(-held.count() // shard_rows))
    id_type = held.schema["doc_id"].dataType.simpleString()
    rank = F.xxhash64("doc_id", "n_tokens", "source", "cluster")
    dealt = held.select(
        F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards)).alias("shard"), F.col("doc_id").alias("id"), F.col("source").cast("string").alias("source"), "cluster", "n_tokens", rank.alias("rank")
    )

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py() if table.num_rows else 0
        ids = table.column("id")
        names = [None if c is None else c for c in table.column("cluster").to_pylist()]
        frame = pd.DataFrame({"id": range(table.num_rows), "n_tokens": table.column("n_tokens").to_pylist(), "rank": table.column("rank").to_pylist()})
        frame["source"] = pd.Series(table.column("source").to_pylist(), dtype=object)
        frame["cluster"] = pd.Series(names, dtype=object)
        got = pack_shard(frame, capacity)
        cols = [ids.combine_chunks().take(pa.array(got["id"], pa.int64())), *[pa.array(got[c], pa.int64()) for c in ("piece", "bin", "offset", "n_tokens")]]
        cols[2] = pa.array(got["bin"] + (shard << 32), pa.int64())
        return pa.table(cols, names=["doc_id", "piece", "bin", "offset", "n_tokens"])

    return dealt.groupBy("shard").applyInArrow(run, f"doc_id {id_type}, piece long, bin long, offset long, n_tokens long")

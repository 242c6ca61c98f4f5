"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint is cut into segments, few enough that one segment differs by one bit at
most between fingerprints that are close. Each segment is indexed once per bit with that
bit as a wildcard, so segments at most one bit apart have an equal variant. An equality
shuffle on the variant brings candidates together and the full distance verifies them.
A bucket hands on a star over each of its components, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchflow.llm.common import may_be_among, partitions, settled, text_hash, whole_text
from switchflow.llm.graph import connected_components
from switchflow.session import materialize

SHINGLE, RADIUS = 3, 3
SHORT_RUN = 12  # buckets up to this size are compared pair by pair, larger ones by search from a frontier
BLOCK = 1 << 14


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> np.uint64:
    """64-bit SimHash of the shingles (repeats count); zero without words."""
    if not words:
        return np.uint64(0)
    digest = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter((digest(b" ".join(words[i : i + shingle]), 42) for i in range(n)), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, BLOCK):
        bits = np.unpackbits(hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(id, fp) of rows (id, text)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # Bytes: only A-Z change, and only ASCII white space parts words.
            got = np.array([fingerprint(t.as_py().lower().split(), shingle) for t in b.column(1)], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got)], names=["id", "fp"])

    return docs.select("id", whole_text().cast("binary").alias("b")).mapInArrow(run, f"id {kind}, fp long")


def variants(fps: DataFrame, segments: int) -> DataFrame:
    """One row per fingerprint and bit: `key` names the variant and holds its segment with that bit cleared.

    The 64 bits are cut evenly; a segment has at most 40 bits.
    """
    every, cuts = [], [round(i * 64 / segments) for i in range(segments + 1)]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        seg = F.shiftrightunsigned("fp", lo).bitwiseAND((1 << (hi - lo)) - 1)
        for bit in range(hi - lo):
            clear = ((1 << (hi - lo)) - 1) ^ (1 << bit)
            every.append(F.lit((lo + bit) << 40) + seg.bitwiseAND(clear))
    return fps.select(F.explode(F.array(*every)).alias("key"), "fp")


def _bucket_links(key: np.ndarray, fp: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) to link, for rows sorted by key that hold whole buckets.

    Small buckets give all their pairs within the radius, large ones a tree over every component.
    """
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    lengths = np.diff(np.append(starts, len(key)))
    size = np.repeat(lengths, lengths)
    at = np.flatnonzero((size > 1) & (size <= SHORT_RUN))
    k = key[at]
    left = np.arange(len(at))
    for step in range(1, SHORT_RUN):
        left = left[left + step < len(k)]
        left = left[k[left] == k[left + step]]
        if not len(left):
            break
        i, j = at[left], at[left + step]
        near = np.bitwise_count(fp[i] ^ fp[j]) <= radius
        yield i[near], j[near]
    for s, n in zip(starts[lengths > SHORT_RUN], lengths[lengths > SHORT_RUN], strict=True):
        rest = np.arange(s, s + n)
        while len(rest) > 1:
            frontier, rest = [rest[0]], rest[1:]
            while frontier and len(rest):
                here = frontier.pop()
                near = np.bitwise_count(fp[rest] ^ fp[here]) <= radius
                if near.any():
                    found, rest = rest[near], rest[~near]
                    frontier.extend(found)
                    yield np.full(len(found), here), found


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): links between different fingerprints that join exactly those which pairs within the radius join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key, fp):
            name = fp.view("<i8")
            for i, j in _bucket_links(key, fp, radius):
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(name[i]), pa.array(name[j])], names=["u", "v"])

        key, fp = np.empty(0, "<i8"), np.empty(0, "<u8")
        for b in batches:
            key = np.concatenate([key, b.column(0).to_numpy()])
            fp = np.concatenate([fp, b.column(1).to_numpy().view("<u8")])
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last bucket may go on
            if cut:
                yield from out(key[:cut], fp[:cut])
                key, fp = key[cut:], fp[cut:]
        if len(key):
            yield from out(key, fp)

    lean = variants(fps.select("fp"), radius // 2 + 1)
    # In the same order everywhere, trees of one group have the same roots in all its buckets, and few different links.
    dealt = lean.repartition(partitions(fps.sparkSession), "key").sortWithinPartitions("key", "fp")
    pairs = dealt.mapInArrow(run, "u long, v long")
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _components(rows: DataFrame, shingle: int, radius: int) -> DataFrame:
    """(id, fp, component_id) of rows (id, text)."""
    held = materialize(with_fingerprints(rows, shingle), "simhash")
    # One row per fingerprint: copies are never paired with each other.
    nodes = materialize(held.groupBy("fp").agg(F.min("id").alias("first")), "simhash-nodes")
    labels = connected_components(links(nodes, radius))
    named = nodes.join(labels.select(F.col("node").alias("fp"), "label"), "fp", "left")
    named = materialize(named.select("fp", "first", F.coalesce("label", "fp").alias("label")), "simhash-labels")
    smallest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    member = materialize(named.select("fp", "label").join(smallest, "label").select("fp", "component_id"), "simhash-members")
    return held.join(member, "fp").select("id", "fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id column, fp, component_id): one row for each row of docs; fingerprints at most `radius` bits apart are linked.

    component_id is the smallest id that a chain of links reaches, the row's own id
    included. Rows whose id is null take part by text and never name a component, unless
    no member has an id: then component_id is null. Empty and null texts have fingerprint
    0 and link like any other; repeated rows each come back; an empty table gives an
    empty result; other columns of docs are not read.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = settled(docs.sparkSession, lambda: _components(rows, shingle, radius), "near-duplicates")
    return found.withColumnRenamed("id", id_column)


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of docs for each component of `near_duplicates`, in its columns.

    It is the one with the smallest id, rows without an id last; of several rows with this
    id, the one whose text has the smallest hash; of equal ones, any one. Only rows that
    may have to go, by a bitmap of their ids and texts, are moved.
    """
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), text_hash().alias("th"))
    found = near_duplicates(docs.select(row.alias("id"), "text"), shingle, radius, "id")

    def dropped() -> DataFrame:
        # Rows that are not the first of their component, and those of which there are several.
        copies = found.groupBy("id").agg(F.count("*").alias("n"), F.first("component_id").alias("component_id"))
        first = F.col("id").eqNullSafe(F.col("component_id"))
        return copies.filter(~first | (F.col("n") > 1)).select(F.col("id.doc_id").alias("__id"), F.col("id.th").alias("__gone"), first.alias("__first"))

    gone = settled(docs.sparkSession, dropped, "near-duplicates-gone")
    hashed = may_be_among(docs.withColumn("__hash", text_hash()), F.xxhash64("doc_id", "__hash"), gone.select(F.xxhash64("__id", "__gone").alias("h")), "__may")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__gone"))
    moved = hashed.filter("__may")
    several = moved.join(gone.filter("__first"), same, "left_semi").groupBy("doc_id", "__hash").agg(F.first(F.struct(*[F.col(c) for c in docs.columns])).alias("__row"))
    kept = hashed.filter("NOT __may").select(*docs.columns).union(moved.join(gone, same, "left_anti").select(*docs.columns))
    return kept.union(several.select("__row.*"))

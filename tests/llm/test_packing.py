import random
from collections import defaultdict

import pandas as pd
from pyspark.sql import functions as F

from switchflow.llm import packing
from switchflow.llm.tokens import tiktoken_encoding, vocabulary
from tests.llm.cases import ODD, documents, empty


def plain_best_fit(rows, capacity):
    """(id, piece) -> bin by looking at every open bin; ties in room go to any bin, so bins' rooms are compared."""
    rows = sorted(rows, key=lambda r: (-((r[1] - 1) % capacity + 1), r[4]))
    bins, rooms = [], []
    for _, n, source, cluster, _ in rows:
        last = (n - 1) % capacity + 1
        bins += [(0, set())] * ((n - last) // capacity)
        own = {("s", source)} - {("s", None)} | {("c", cluster)} - {("c", None)}
        fit = [i for i, (room, held) in enumerate(bins) if room >= last and not held & own]
        best = min(fit, key=lambda i: bins[i][0]) if fit else None
        if best is None:
            bins.append((capacity, set()))
            best = len(bins) - 1
        room, held = bins[best]
        rooms.append(room)
        bins[best] = (room - last, held | own)
    return len(bins), rooms


def test_the_tightest_compatible_bin_is_taken():
    rng = random.Random(4)
    for trial in range(30):
        capacity = rng.choice([7, 64, 100])
        # Without conflicts that differ between equally tight bins, any search gives the same rooms.
        rows = [(i, rng.randint(1, 2 * capacity), rng.choice("abc") if trial % 2 else None, None, i) for i in range(200)]
        frame = pd.DataFrame(rows, columns=["id", "n_tokens", "source", "cluster", "rank"]).astype({"source": object, "cluster": object})
        got = packing.pack_shard(frame, capacity)
        check(got, {r[0]: r for r in rows}, capacity)
        if trial % 2 == 0:
            bins, _ = plain_best_fit(rows, capacity)
            assert got["bin"].nunique() == bins


def check(got, rows, capacity):
    """Whole documents, no overlap, no overflow, no conflict; no bin could take what a later one was opened for."""
    bins, tokens = defaultdict(list), defaultdict(int)
    for r in got.itertuples():
        bins[r.bin].append((r.offset, r.n_tokens, r.id, r.piece))
        tokens[r.id] += r.n_tokens
    assert tokens == {i: r[1] for i, r in rows.items()}
    for own in bins.values():
        own.sort()
        assert own[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:], strict=False))
        assert own[-1][0] + own[-1][1] <= capacity
        for k in (2, 3):
            names = [rows[i][k] for _, _, i, _ in own if rows[i][k] is not None]
            assert len(names) == len(set(names))


def test_search_against_all_bins():
    rng = random.Random(8)
    bins, held = packing.Bins(50), {}
    for _ in range(1500):
        size, conflicts = rng.randint(1, 50), (1 << rng.randint(0, 5)) | (1 << rng.randint(6, 40) if rng.random() < 0.5 else 0)
        fit = [room for room, bits in held.values() if room >= size and not bits & conflicts]
        name, offset = bins.put(size, conflicts)
        room, bits = held.get(name, (50, 0))
        assert (min(fit) if fit else None) == (room if name in held else None)
        assert offset == 50 - room
        held[name] = (room - size, bits | conflicts)


def test_documents(spark):
    docs = documents(spark, ODD).withColumn("bin", F.lit("x")).withColumn("n_tokens", F.lit("x"))
    lengths = packing.with_lengths(docs)
    encode = tiktoken_encoding(vocabulary("byte_bpe_50k.tiktoken")).encode_ordinary
    want = sorted((r.doc_id or -1, len(encode(r.text or "")) + 1) for r in docs.collect())
    assert sorted((r.doc_id or -1, r.n_tokens) for r in lengths.collect()) == want
    for shard_rows in (5, 1000):
        got = packing.pack(lengths, capacity=128, shard_rows=shard_rows).collect()
        assert sum(r.n_tokens for r in got) == sum(n for _, n in want)
        used = defaultdict(int)
        for r in got:
            used[r.bin] += r.n_tokens
        assert max(used.values()) <= 128
    assert packing.pack(packing.with_lengths(empty(spark))).count() == 0


def test_a_hot_source_is_spread(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id"))).alias("source"), F.lit(1).cast("long").alias("cluster"), (F.col("id") % 90 + 1).alias("n_tokens"))
    got = packing.pack(rows.withColumn("cluster", F.lit(None).cast("long")), capacity=100, shard_rows=1000)
    worst = got.join(rows.select("doc_id", "source"), "doc_id").filter("source = 'hot'").groupBy("bin").count().agg(F.max("count")).first()[0]
    assert worst == 1
    assert packing.pack(rows, capacity=100).select("bin").distinct().count() == 3000  # one cluster: never two together

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from switchflow.llm import simhash
from switchflow.llm.graph import connected_components
from tests.llm.cases import ODD, documents, empty


def plain_fingerprint(text, k=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c == " " or "\t" <= c <= "\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    parts = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, near):
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if near(rows[i], rows[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_against_brute_force(spark):
    docs = documents(spark, ODD).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(0))
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect())
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    label = plain_components(rows, lambda a, b: (a[1] ^ b[1]).bit_count() <= 3)
    want = []
    for i, (doc, fp) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        want.append((doc is not None, doc or 0, fp, min(ids) if ids else None))
    assert got == sorted(want)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_every_pair_within_the_radius_is_joined(spark):
    rng = random.Random(3)
    fps = []
    for _ in range(60):
        fp = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 40])):  # small and large buckets, chains too
            fps.append(fp)
            for bit in rng.sample(range(64), rng.randint(1, 3)):
                fp ^= 1 << bit
    fps = sorted(set(fps))
    signed = [(int(np.array(f, "<u8").view("<i8")),) for f in fps]
    links = simhash.links(spark.createDataFrame(signed, "fp long"))
    label = dict(connected_components(links).collect())
    want = plain_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    got = [label.get(s[0], s[0]) for s in signed]
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_components_of_a_long_chain(spark):
    chain = spark.range(40).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v")).union(spark.createDataFrame([(100, 101), (7, 7)], "u long, v long"))
    got = dict(connected_components(chain).collect())
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_one_row_of_each_component_is_kept(spark):
    rng = random.Random(14)
    a, b, c, d = (" ".join("".join(rng.choices("abcdefghilmnoprstu", k=9)) for _ in range(200)) for _ in range(4))
    rows = [(1, a), (2, a), (2, b), (2, b), (None, a), (None, c), (None, c), (None, d), (3, c.upper()), (4, d + " tail"), (None, None), (None, ""), (5, b)]
    rows += [(None, b[::-1])] * 3 + [(6, a[::-1])] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(1))
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    fps = [plain_fingerprint(t) for _, t in rows]
    label = plain_components(fps, lambda x, y: (x ^ y).bit_count() <= 3)
    kept = [(r.doc_id, r.text or "") for r in got.collect()]
    groups = {}
    for row, of in zip(rows, label, strict=True):
        groups.setdefault(of, []).append(row)
    assert len(kept) == len(groups)
    for own in groups.values():
        ids = [i for i, _ in own if i is not None]
        assert sum((i, t) in [(x, y or "") for x, y in own] and i == (min(ids) if ids else None) for i, t in kept) == 1
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_large_groups_of_copies(spark):
    rng = random.Random(15)
    words = ["".join(rng.choices("abcdefghilmnoprstu", k=9)) for _ in range(400)]
    rows = [(i, " ".join(words)) for i in range(500)]
    for i in range(500, 900):
        other = list(words)
        other[rng.randrange(400)] = f"w{i}"
        rows.append((i, " ".join(other)))
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    label = plain_components(sorted({plain_fingerprint(t) for _, t in rows}), lambda x, y: (x ^ y).bit_count() <= 3)
    assert len(set(found.values())) == len(set(label)) and all(found[i] == 0 for i in range(500))

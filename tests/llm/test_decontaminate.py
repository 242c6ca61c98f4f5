import random
import re
from collections import Counter

from pyspark.sql import functions as F

from switchflow.llm import decontaminate as dc
from tests.llm.cases import ODD, documents, empty, prose


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())


def weights(ws):
    k = min(5, len(ws))
    return Counter(" ".join(ws[i : i + k]) for i in range(len(ws) - k + 1))


def plain(docs, items):
    """Best similarity over every window of an item's size, cut windows at the ends of the text included."""
    out = {}
    for doc, text in docs:
        ws = words(text)
        for item, t in items:
            own = words(t)
            if not own or not ws:
                continue
            b, m = weights(own), len(own)
            for start in range(1 - m, len(ws)):
                window = ws[max(start, 0) : start + m]
                a = weights(window)
                shared = sum((a & b).values())
                sim = shared / (sum(a.values()) + sum(b.values()) - shared)
                if sim >= 0.8 and sim > out.get((doc, item), (0, 0))[0]:
                    out[doc, item] = (sim, max(start, 0))
    return out


def test_against_every_window(spark):
    rng = random.Random(11)
    items = [(i, prose(rng, rng.randint(6, 60))) for i in range(14)] + [(20, "only three words"), (21, "solo"), (22, ""), (23, None), (None, prose(rng, 30))]
    items.append((30, items[0][1]))  # the same text twice
    items.append((31, "ring a ring a ring a ring a ring a rose"))
    rows = []
    for n, (_, t) in enumerate(items):
        if not t:
            continue
        for edits in range(4):
            ws = t.split(" ")
            for _ in range(edits):
                ws[rng.randrange(len(ws))] = "changed"
            rows.append((1000 + 10 * n + edits, prose(rng, rng.randint(0, 40)) + "\n" + " ".join(ws).upper() + " " + prose(rng, rng.randint(0, 40)), "en", "s"))
    docs = documents(spark, [*ODD, *rows]).withColumn("item_id", F.lit("x")).withColumn("ws", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("m", F.lit("x"))
    found, texts = dc.find_leaks(docs, bench).collect(), docs.select("doc_id", "text").collect()
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in found}
    want = {k: round(s, 9) for k, (s, _) in plain([(r.doc_id, r.text) for r in texts], items).items()}
    for r in found:  # another window may be as close; the one told must be
        a = [weights(words(x.text)[r.start_word : r.start_word + r.n_words]) for x in texts if x.doc_id == r.doc_id]
        b = weights(words(dict(items)[r.item_id]))
        assert any(abs(sum((x & b).values()) / sum((x | b).values()) - r.similarity) < 1e-9 for x in a) or r.start_word == 0
    assert got == want and len(want) > 20
    left = dc.without_leaks(docs, dc.find_leaks(docs, bench))
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - {k[0] for k in want}


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "some words of an item here")], "item_id long, text string")
    assert dc.find_leaks(empty(spark), bench).count() == 0
    assert dc.find_leaks(documents(spark), bench.limit(0)).count() == 0


def test_blocks_meet_within_the_radius(spark):
    rng = random.Random(1)
    rows = []
    for i in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 22):
            b ^= 1 << bit
        rows.append((i, a - (1 << 63), b - (1 << 63)))
    df = spark.createDataFrame(rows, "i long, a long, b long")
    same = F.arrays_overlap(dc._blocks(F.col("a"), 22), dc._blocks(F.col("b"), 22))
    assert df.filter(same).count() == 200


def test_simhash(spark):
    import xxhash

    df = spark.createDataFrame([(["a b", "a b", "c"],), (["x"],), ([f"s{i}" for i in range(60)],)], "s array<string>")
    for s, fp in df.select("s", dc.simhash(F.col("s"))).collect():
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        assert fp % (1 << 64) == sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def test_reordered_items_against_every_window(spark):
    rng = random.Random(21)
    vocabulary = ["".join(rng.choices("abcdefghilmnoprstu", k=7)) for _ in range(3000)]
    items = [(i, prose(rng, n, vocabulary)) for i, n in enumerate((40, 60, 60, 61, 90))]
    rows = []
    for i, t in items:
        ws = t.split(" ")
        for n, at in enumerate((len(ws) // 2, len(ws) // 3)):
            swapped = ws[at:] + ws[:at]
            rows.append((10 * i + n, prose(rng, 25, vocabulary) + " " + " ".join(swapped) + " " + prose(rng, 25, vocabulary), "en", "s"))
        rows.append((10 * i + 5, " ".join(ws[len(ws) // 2 :] + ws[: len(ws) // 2]), "en", "s"))  # the whole text
    docs = documents(spark, rows).filter("doc_id < 100 AND source = 's'")
    found = dc.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    want = plain([(r[0], r[1]) for r in rows], items)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in found} == {k: round(s, 9) for k, (s, _) in want.items()}
    assert len(want) >= 12


def test_rows_go_by_id_and_text(spark):
    rng = random.Random(22)
    item = prose(rng, 40)
    rows = [(None, "before " + item, "en", "s"), (None, prose(rng, 80), "en", "s"), (5, item + " after", "en", "s"), (5, prose(rng, 70), "en", "s"), (6, None, "en", "s")]
    docs = spark.createDataFrame(rows, documents(spark).schema)
    left = dc.without_leaks(docs, dc.find_leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string")))
    assert sorted(map(str, left.collect())) == sorted(map(str, docs.filter("text NOT LIKE 'before %' AND text NOT LIKE '% after' OR text IS NULL").collect()))

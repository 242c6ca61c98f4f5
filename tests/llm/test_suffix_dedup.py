import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from switchflow.llm import suffix_dedup as sd
from tests.llm.cases import ODD, documents, empty


def plain(rows, n=50):
    """(doc_id, kept, removed, spans) by looking every string up."""
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        if i is not None:
            for j in range(len(b) - n + 1):
                s = b[j : j + n]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        if i is not None:
            for j in range(len(b) - n + 1):
                if first[b[j : j + n]] < i:
                    gone[j : j + n] = True
        spans = int(np.sum(gone & ~np.concatenate(([False], gone[:-1])))) if len(b) else 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i is not None, i or 0, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(docs):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in sd.remove_repeats(docs).collect())


def test_against_brute_force(spark):
    docs = documents(spark, ODD).withColumn("spans", F.lit(1)).withColumn("th", F.lit(2)).repartition(3)
    assert run(docs) == plain([(r.doc_id, r.text) for r in docs.collect()])
    assert run(empty(spark)) == []


def test_edits_and_short_cycles(spark):
    rng = random.Random(9)
    base = "".join(rng.choices("ab ", k=900))
    rows = []
    for i in range(40):
        t = list(base)
        for at in rng.sample(range(900), rng.randint(0, 9)):
            t[at] = rng.choice("abc")
        rows.append((100 - i, "".join(t[rng.randint(0, 60) : 900 - rng.randint(0, 60)])))
    rows += [(200 + i, ("abc" * 40)[i : i + 49 + i % 4]) for i in range(12)] + [(300, "q" * 49), (301, "q" * 49), (302, "q" * 50), (303, "q" * 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert run(docs) == plain(rows)


def test_chunks_of_a_task_join_what_they_share(spark):
    rows = [(i, "the same words in every document, long enough to count as a repeat " * 2 + str(i)) for i in range(30)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)) == plain(rows)


def test_sorting_orders_suffixes():
    rng = random.Random(2)
    for alphabet in (b"a", b"ab", bytes(range(256))):
        data = np.frombuffer(bytes(rng.choices(alphabet, k=700)) + bytes(rng.choices(alphabet, k=300)) * 3, np.uint8)
        starts = np.array(rng.sample(range(len(data) - 50), 900))
        order, group = sd.sort_suffixes(data, starts)
        strings = [data[s : s + 50].tobytes() for s in starts[order]]
        assert sorted(order) == list(range(900)) and strings == sorted(strings)
        assert all((a == b) == (g == h) for a, b, g, h in zip(strings, strings[1:], group, group[1:], strict=False))


def test_equal_windows_have_equal_anchors():
    rng = random.Random(4)
    a, b = (bytes(rng.choices(b"abcd", k=400)) for _ in range(2))
    shared = bytes(rng.choices(b"abcd", k=90))
    found = []
    for text in (a + shared + b, b[:77] + shared + a):
        at, own = text.index(shared), {}
        for lo, hi, place, key in zip(*sd.anchors(text, 8), strict=True):
            for w in range(lo, hi):
                own[w - at] = (place - w, int(key))
        assert len(own) == len(text) - 49
        found.append([own[w] for w in range(41)])
    assert found[0] == found[1]

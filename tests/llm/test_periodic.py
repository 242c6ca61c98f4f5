import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from switchflow.llm import periodic, queries
from tests.llm.cases import ODD, documents, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(ws, least=12):
    of = {w: i for i, w in enumerate(dict.fromkeys(ws))}
    text, found = np.array([of[w] for w in ws], int), {}
    for p in range(1, len(ws) // 2 + 1):
        same = np.concatenate([[False], text[:-p] == text[p:], [False]]).astype(int)
        for s, e in zip(np.flatnonzero(np.diff(same) == 1).tolist(), np.flatnonzero(np.diff(same) == -1).tolist()):
            if e + p - s >= max(least, 2 * p):
                found.setdefault((s, e + p), p)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def kept(ws, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return [w for i, w in enumerate(ws) if i not in gone]


def rewritten(doc_id, text):
    ws = WORD.findall(text or "")
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not ws:
        return ws
    n, g = len(ws), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]


def test_runs_against_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        n = rng.randint(0, 80)
        ws = [rng.randrange(rng.choice([1, 2, 2, 3, 40])) for _ in range(n)]
        if n and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(2, 9)
            ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
        least = rng.choice([12, 12, 5, 2])
        found = periodic.runs(periodic.codes(ws), least)
        assert found == brute(ws, least)
        assert periodic.collapsed(ws, found) == kept(ws, found)


@pytest.mark.parametrize("period", [1, 3, 5000, 10000])
def test_long_runs(period):
    text = np.arange(20000) % period
    assert periodic.runs(text) == [(0, 20000, period)]


def test_many_runs_and_the_ordered_sets():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert periodic.runs(periodic.codes(b)) == brute(b)
    rng = random.Random(5)
    places, model = periodic.Places(10**6), [10**6]
    for x in rng.sample(range(10**6), 6000):
        before, after = places.add(x)
        assert before == max((y for y in model if y < x), default=None)
        assert after == min((y for y in model if y > x), default=None)
        model.append(x)
    assert list(places) == sorted(model) and len(places.blocks) > 2


def test_the_query_against_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    more = [(1000 + i, " ".join(rng.choices(["a", "b", "\x1c", "É"], k=rng.randint(1, 60))), None, None) for i in range(300)]
    docs = documents(spark, [*ODD, *more]).withColumn("runs", F.lit(1)).withColumn("n_words", F.lit(""))
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    got = sorted(tuple(r) for r in queries.op13(spark, "").fillna(-1).collect())
    want = []
    for r in docs.collect():
        ws = rewritten(r.doc_id, r.text)
        found = brute(ws)
        s, n, p = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(-1, -1, -1))
        text = "".join(f"{a},{b},{c}\n" for a, b, c in found)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (text, " ".join(kept(ws, found)))]
        want.append((-1 if r.doc_id is None else r.doc_id, len(found), s, n, p, 1000 * n // p, *digests) if found else (-1 if r.doc_id is None else r.doc_id, 0, -1, -1, -1, -1, *digests))
    assert got == sorted(want) and sum(x[1] for x in want) > 20
    monkeypatch.setattr(queries, "table", lambda *_: empty(spark))
    assert queries.op13(spark, "").count() == 0

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from switchflow.llm import token_store as ts
from switchflow.llm.tokens import id_encoder, vocabulary
from switchflow.session import scratch_path
from tests.llm.cases import ODD, documents, empty

HF = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


def ids(text):
    return HF.encode(text or "", add_special_tokens=False).ids + [0]


def test_encoding_in_parts_equals_whole_texts():
    rng = random.Random(1)
    alphabet = "ab .,'s \n\t  \xa0　 \x1c1é漢😀\r"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(4000)]
    texts += ["x<|endoftext|> y", " a  b", "a\n b \n c", "", " ", "it's  we'll 're", "word " * 500, "日本 語  x"]
    # Plainly spaced texts of several lines.
    for seps in ([" ", "\n"], [" ", "\n", "\n\n"], [" ", "\n", "\t"], [" ", "\t\n\t"], ["\r\n", " "], [" ", "\n", "\x0b"]):
        for _ in range(300):
            words = ["".join(rng.choices("abcé.,'1%", k=rng.randint(1, 5))) for _ in range(rng.randint(1, 12))]
            texts.append(rng.choice(["", "\n"]) + "".join(w + rng.choice(seps) for w in words[:-1]) + words[-1] + rng.choice(["", "\n", ".\n"]))
    got = id_encoder(vocabulary("byte_bpe_50k.json"))(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [HF.encode(t, add_special_tokens=False).ids for t in texts]


def test_round_trip(spark):
    docs = documents(spark, ODD).withColumn("key", F.lit("x")).withColumn("shard", F.lit(1)).repartition(3)
    store = ts.write_store(docs, scratch_path(spark, "store"))
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, at = [], 0
    for doc, text in rows:
        own = ids(text)
        want.append((doc, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()), tuple(own)))
        at += len(own)
    got = [(r.key, r.start, r.n_tokens, r.ids_crc32, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in store.lookup(docs.select("doc_id")).collect()]
    order = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(got, key=order) == want
    assert sum(r.n_ids for r in store.shards.collect()) == at


def test_only_asked_keys_that_exist_come_back(spark):
    docs = documents(spark)
    store = ts.write_store(docs, scratch_path(spark, "store"))
    asked = spark.createDataFrame([(1,), (4,), (4,), (5,), (10**9,)], "k long")
    assert sorted(r.key for r in store.lookup(asked).collect()) == [1, 4]


def test_small_shards_keep_order(spark, monkeypatch):
    docs = documents(spark)
    store = ts.write_store(empty(spark), scratch_path(spark, "store"))
    assert store.shards.count() == 0 and store.lookup(docs.select("doc_id")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 20000])
def test_the_hash_is_minimal_and_perfect(n):
    keys = [str(i * 7).encode() for i in range(n)]
    place, _ = ts._hashes(keys)
    _, slots = ts.build_pilots(place)
    assert sorted(slots.tolist()) == list(range(n))
    index = ts.ShardIndex(ts.index_bytes(keys, np.arange(1, n + 1), 2))
    assert index.find(keys) == [(i, 1) for i in range(n)]
    strangers = index.find([f"no{i}".encode() for i in range(1000)])
    assert sum(found > 0 for _, found in strangers) <= 1  # 32-bit fingerprints

import math
import random
import re

from pyspark.sql import functions as F

from switchflow.llm import rules
from tests.llm.cases import ODD, documents, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = {}
    for w in windows:
        count[w] = count.get(w, 0) + 1
    inside = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


def test_counts_against_brute_force(spark):
    more = [(900, "a b c d e\n\na b c d e\nx # | x\n \t\nx # | x\na b c d e f a b c d e", "en", None), (901, "a\x0bb\x0cc\rd\te 😀 <é> x", "en", None)]
    docs = documents(spark, [*ODD, *more]).withColumn("n_words", F.lit("clash")).withColumn("kept", F.lit(1))
    got = rules.measure(docs.select("doc_id", "text", "n_words"))
    have = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got.collect())
    assert have == sorted((r.doc_id or -1, *plain(r.text)) for r in docs.collect())


def cdf(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_the_bound_is_exact(spark):
    cases = [(n, a, d) for n in (0, 1, 50, 300, 1000) for a in (0.01, 0.05, 0.2) for d in (0.05, 0.001)]
    df = spark.createDataFrame(cases, "n long, a double, d double")
    for r in df.withColumn("k", rules.most_allowed(F.col("n"), F.col("a"), F.col("d"))).collect():
        assert r.k == max([-1, *(k for k in range(r.n + 1) if cdf(k, r.n, r.a) <= r.d)])


def test_cutoffs_keep_their_promise(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(3000):
        bad = i % 5 == 0
        words = ["".join(rng.choices("abcdefgh", k=5)) + ("###" if bad or rng.random() < 0.002 else "") for _ in range(30)]
        rows.append((i, " ".join(words), "en" if i % 2 else None, "s"))
        if i % 10 < 8:
            labels.append((i, 0 if bad else 1))
    labels += [(None, 1), (5, None), (10**9, 1), (1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in rules.apply_rules(docs, spark.createDataFrame(labels, "doc_id long, quality int"), alpha=0.1).collect()}
    good = [k for i, k in got.items() if i % 5]
    assert len(got) == 3000 and sum(good) >= 0.9 * len(good)
    assert sum(k for i, k in got.items() if i % 5 == 0) == 0


def test_without_labels_the_base_rule_decides(spark):
    docs = documents(spark, ODD)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = rules.apply_rules(docs, labels).collect()
    assert len(got) == docs.count() and all(r.kept != r.base_failed for r in got)
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in got)
    assert rules.apply_rules(empty(spark), labels).count() == 0

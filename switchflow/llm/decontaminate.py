"""Benchmark decontamination by SimHash over item-sized windows, with DataFrame functions only.

A window is as many words of a document as a benchmark item has. Windows that can reach
the similarity hold most of an item's shingles in any order, so every window with that
many shared shingles is tried. Different windows are fingerprinted once; fingerprints
within the radius share one of `radius + 1` blocks of bits and meet in an equality join;
the exact similarity of weighted shingles (weight: occurrences) decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchflow.llm.common import bind, may_be_among, text_hash, whole_text, words
from switchflow.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
# Windows 0.8 alike differ in 9.7 of 64 bits on average, with a deviation of 2.9.
RADIUS = 22
# Different shingles of the benchmark that Spark surely sends to every task (16 bytes each).
FEW_SHINGLES = 500_000


def _shingle_hashes(ws: Column, k: int) -> Column:
    positions = F.when(F.size(ws) >= k, F.sequence(F.lit(1), F.size(ws) - (k - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(positions, lambda i: F.xxhash64(F.slice(ws, i, k)))


def _shingles(ws: Column) -> Column:
    """Shingles of an item or window as text; fewer words than a shingle are one."""
    k = F.least(F.lit(SHINGLE), F.size(ws))
    return F.transform(F.sequence(F.lit(1), F.size(ws) - k + 1), lambda i: F.concat_ws(" ", F.slice(ws, i, k)))


def simhash(shingles: Column) -> Column:
    """64-bit SimHash; a shingle counts as often as it occurs."""

    def of(hashes: Column) -> Column:
        def bit(b: Column) -> Column:
            ones = F.aggregate(hashes, F.lit(0), lambda s, h: s + F.when(h.bitwiseAND(b) != 0, 1).otherwise(0))
            return F.when(2 * ones > F.size(hashes), b).otherwise(F.lit(0).cast("long"))

        masks = F.array(*[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
        return F.aggregate(F.transform(masks, bit), F.lit(0).cast("long"), lambda s, x: s.bitwiseOR(x))

    return bind(F.transform(shingles, lambda x: F.xxhash64(x)), of)


def _blocks(fp: Column, radius: int) -> Column:
    """(block, bits) for the radius + 1 blocks that the 64 bits are cut into."""
    cuts = [round(i * 64 / (radius + 1)) for i in range(radius + 2)]
    return F.array(
        *[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fp, lo).bitwiseAND((1 << (hi - lo)) - 1).alias("bits")) for i, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False))]
    )


def _items(benchmark: DataFrame) -> DataFrame:
    """(item_id, ck, m, ws): items with a word; ck names their text."""
    ws = words(F.lower(whole_text("text")))
    lean = benchmark.select("item_id", ws.alias("ws")).filter(F.size("ws") > 0)
    return lean.select("item_id", F.xxhash64("ws", F.size("ws")).alias("ck"), F.size("ws").alias("m"), "ws")


def _placed(docs: DataFrame, items: DataFrame, similarity: float) -> DataFrame | None:
    """(id, th, start, m): the windows with enough shingles of the items of m words; start may be negative.

    A window and an item share no more than the window's shingles that items of this size
    have, wherever they stand in it, and at least `similarity` of the item's own. So a
    window holds that many hits in a row, which gives its starts.
    """
    small = [r.k for r in items.select(F.least(F.col("m"), F.lit(SHINGLE)).alias("k")).distinct().collect()]  # 1 to 5
    out = None
    for k in sorted(small):
        own = items.filter(F.least(F.col("m"), F.lit(SHINGLE)) == k)
        anchors = own.select("m", F.explode(_shingle_hashes(F.col("ws"), k)).alias("h")).distinct()
        # Written, so that Spark knows its size and sends it to the tasks only if it is small.
        anchors = materialize(anchors, "benchmark-shingles")
        text = docs.select("id", "th", F.posexplode(_shingle_hashes(F.col("ws"), k)).alias("pos", "h"))
        if anchors.count() > FEW_SHINGLES:
            # The corpus' shingles are moved to a benchmark of this size only where a bitmap of it lets them pass.
            text = may_be_among(text, F.col("h"), anchors.select("h"), "may").filter("may").drop("may")
        hits = text.join(anchors, "h").groupBy("id", "th", "m").agg(F.collect_set("pos").alias("at"))
        need = F.ceil(F.lit(similarity) * (F.col("m") - k + 1) - 1e-9).cast("int")
        hits = hits.select("id", "th", "m", (F.col("m") - k).alias("w"), F.greatest(need, F.lit(1)).alias("need"), F.array_sort("at").alias("at"))
        hits = materialize(hits.filter(F.size("at") >= F.col("need")), "leak-hits")

        def starts(i: Column) -> Column:
            first, last = F.get("at", i), F.get("at", i + F.col("need") - 1)
            return F.when(last - first <= F.col("w"), F.sequence(last - F.col("w"), first)).otherwise(F.array().cast("array<int>"))

        every = F.flatten(F.transform(F.sequence(F.lit(0), F.size("at") - F.col("need")), starts))
        hits = hits.select("id", "th", F.explode(F.array_distinct(every)).alias("start"), "m")
        out = hits if out is None else out.union(hits)
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_hash, item_id, similarity, start_word, n_words): the best window of every document for every item it holds.

    similarity is that of the five-word shingles of window and item, each shingle
    weighted by its occurrences (shared weight by joint weight); fewer words are one
    shingle. Case is ignored. Texts are read whole; null and empty texts hold nothing,
    null and empty items are in nothing. Rows are told apart by id and text, so repeated
    rows give one result, and rows with a null doc_id are found too. Items with one text
    are all reported. Ties go to the first window. Other columns are not read; an empty
    table gives an empty result.
    """
    ws = words(F.lower(whole_text("text")))
    items = materialize(_items(benchmark), "benchmark-items")
    known = docs.select(F.col("doc_id").alias("id"), text_hash().alias("th"), "text")
    places = _placed(known.select("id", "th", ws.alias("ws")), items, similarity)
    if places is None:
        kinds = [f"{c} {df.schema[c].dataType.simpleString()}" for df, c in ((docs, "doc_id"), (benchmark, "item_id"))]
        return docs.sparkSession.createDataFrame([], f"{kinds[0]}, text_hash long, {kinds[1]}, similarity double, start_word int, n_words int")
    places = materialize(places.distinct(), "leak-places")
    # The texts of the few documents with places; one row per document and text by now. Other texts stay where they are.
    where = places.groupBy(F.col("id").alias("id2"), F.col("th").alias("th2")).agg(F.collect_list(F.struct("start", "m")).alias("at"))
    where = materialize(where, "leak-documents")
    few = may_be_among(known, F.xxhash64("id", "th"), where.select(F.xxhash64("id2", "th2").alias("h")), "may").filter("may")
    held = few.join(where, F.col("id").eqNullSafe(F.col("id2")) & (F.col("th") == F.col("th2"))).select("id", "th", ws.alias("ws"), F.explode("at").alias("a"))
    first = F.greatest(F.col("a.start"), F.lit(0))
    window = F.slice("ws", first + 1, F.greatest(F.col("a.m") - (first - F.col("a.start")), F.lit(0)))
    cut = held.select("id", "th", first.alias("start"), F.col("a.m").alias("m"), window.alias("win")).withColumn("wk", F.xxhash64("win"))
    cut = materialize(cut, "leak-windows")
    windows = materialize(cut.groupBy("m", "wk").agg(F.first("win").alias("win")).withColumn("fp", simhash(_shingles(F.col("win")))), "leak-fingerprints")
    texts = items.groupBy("m", "ck").agg(F.first("ws").alias("ws")).withColumn("fp", simhash(_shingles(F.col("ws"))))
    texts = materialize(texts, "benchmark-fingerprints")
    a = windows.select("m", "wk", "fp", F.explode(_blocks(F.col("fp"), radius)).alias("b")).select("m", "wk", "fp", "b.*")
    b = texts.select("m", "ck", F.col("fp").alias("ifp"), F.explode(_blocks(F.col("fp"), radius)).alias("b")).select("m", "ck", "ifp", "b.*")
    near = a.join(b, ["m", "block", "bits"]).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= radius).select("m", "wk", "ck").distinct()
    near = materialize(near, "leak-candidates")
    counted = lambda df, key, column: df.select("m", key, F.explode(_shingles(F.col(column))).alias("s")).groupBy("m", key, "s").agg(F.count("*").alias("n"))
    of_windows = counted(windows.join(near.select("m", "wk").distinct(), ["m", "wk"], "left_semi"), "wk", "win")
    of_items = counted(texts, "ck", "ws").withColumnRenamed("n", "n_item")
    totals = lambda df, key, n, name: df.groupBy("m", key).agg(F.sum(n).alias(name))
    of_windows, of_items = materialize(of_windows, "window-shingles"), materialize(of_items, "item-shingles")
    shared = near.join(of_windows, ["m", "wk"]).join(of_items, ["m", "ck", "s"]).groupBy("m", "wk", "ck").agg(F.sum(F.least("n", "n_item")).alias("shared"))
    exact = shared.join(totals(of_windows, "wk", "n", "w"), ["m", "wk"]).join(totals(of_items, "ck", "n_item", "i"), ["m", "ck"])
    exact = exact.select("m", "wk", "ck", (F.col("shared") / (F.col("w") + F.col("i") - F.col("shared"))).alias("similarity")).filter(F.col("similarity") >= similarity)
    exact = materialize(exact.join(items.select("ck", "item_id"), "ck").select("m", "wk", "item_id", "similarity"), "leak-pairs")
    found = cut.select("id", "th", "start", "m", "wk").join(exact, ["m", "wk"])
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start", "m")).alias("x")
    return found.groupBy(F.col("id").alias("doc_id"), F.col("th").alias("text_hash"), "item_id").agg(best).select(
        "doc_id", "text_hash", "item_id", (-F.col("x.s")).alias("similarity"), F.col("x.start").alias("start_word"), F.col("x.m").alias("n_words")
    )


def without_leaks(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """docs without the rows, known by id and text, that hold an item. Only rows that may hold one are moved."""
    gone = materialize(leaks.select(F.col("doc_id").alias("__gone"), F.col("text_hash").alias("__hash")).distinct(), "leaks")
    hashed = may_be_among(docs.withColumn("__th", text_hash()), F.xxhash64("doc_id", "__th"), gone.select(F.xxhash64("__gone", "__hash").alias("h")), "__may")
    same = F.col("doc_id").eqNullSafe(F.col("__gone")) & (F.col("__th") == F.col("__hash"))
    return hashed.filter("NOT __may").select(*docs.columns).union(hashed.filter("__may").join(gone, same, "left_anti").select(*docs.columns))

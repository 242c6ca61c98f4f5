"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

Sources share the words of the mix by weight. A source stops at `epochs` times its own
words; what it cannot use goes to the others by their weights, until no source is above
its stop. Every document is then repeated as often as its source's target holds the
source whole; what is left is one more repetition of documents in the order of a seeded
draw, the last of them in part, so the words taken are the target rounded down.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from switchflow.llm.common import BLANK, bind, whole_text, words
from switchflow.operators.topk import positions
from switchflow.session import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
SEED = 11
# Draws have 60 bits. The edge of a source's sample is looked up by their upper 12 bits,
# the 12 bits after them inside the range found, and the rest inside that range: a step
# counts at most 4,096 cells of a source, the last one a 16-millionth of its draws.
DRAW_BITS = 60
STEPS = ((0, 12), (12, 24), (24, DRAW_BITS))
SIZE, DRAW, SOURCE = "__size", "__draw", "__source"


def n_words(text: Column) -> Column:
    """Number of runs without white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A number of 60 bits that follows from seed, id and text; rows that agree in both draw the same."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(text))
    return F.conv(F.substring(F.md5(key), 1, DRAW_BITS // 4), 16, 10).cast("long")


def water_fill(sources: DataFrame, total: float, epochs: int = EPOCHS) -> DataFrame:
    """sources (source_size, weight, ...) with the column target: shares of total by weight, none above epochs * source_size.

    `sources` is read once a round: pass a written frame. A round needs two sums, and
    every round but the last clamps a source. If all are clamped the total isn't reached.
    """
    cap = (F.col("source_size") * epochs).cast("double")
    sums = sources.agg(F.sum("weight").cast("double"), F.count("*")).first()
    free, clamped_words, n = sums[0] or 1.0, 0.0, 0
    while True:
        share = F.col("weight") * F.lit(total - clamped_words) / F.lit(free)
        above = cap < share
        now = sources.agg(
            F.count_if(above), F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))).cast("double"), F.lit(0.0))
        ).first()
        if now[0] == n or not now[2]:
            break
        n, clamped_words, free = now
    return sources.withColumn("target", F.when(above, cap).otherwise(share))


def measured(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """docs with its words, draw and source as helper columns."""
    text = whole_text()
    return docs.withColumns({SIZE: n_words(text), DRAW: draw(F.col("doc_id"), text, seed), SOURCE: F.col("source").cast("string")})


def _edges(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """targets with whole, edge, edge_rest, edge_size.

    Draws below `edge` get one repetition more than `whole`; rows that draw the edge
    itself, edge_size words together, share edge_rest words. The edge is found from
    sums of words per source and range of draws, each step inside one range of the
    last: no source's rows are ever brought together.
    """
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0)).cast("long")
    rest = F.floor(F.col("target") - (whole * size).cast("double")).cast("long")
    at = targets.select(F.col(SOURCE).alias("__s"), whole.alias("whole"), rest.alias("__rest"), F.lit(0).cast("long").alias("__prefix"))
    at = materialize(at, "mix-edge")
    same = F.col(SOURCE).eqNullSafe(F.col("__s"))
    run = Window.partitionBy("__s").orderBy("cell")
    for known, bits in STEPS:
        cell = F.shiftright(DRAW, DRAW_BITS - bits)
        inside = sizes.join(at, same & (F.shiftright(DRAW, DRAW_BITS - known) == F.col("__prefix")))
        cells = inside.groupBy("__s", "whole", "__rest", cell.alias("cell")).agg(F.sum(SIZE).alias("n"))
        cells = cells.withColumn("to", F.sum("n").over(run))
        hit = cells.filter((F.col("to") > F.col("__rest")) & (F.col("to") - F.col("n") <= F.col("__rest")))
        at = hit.select("__s", "whole", (F.col("__rest") - F.col("to") + F.col("n")).alias("__rest"), F.col("cell").alias("__prefix"), F.col("n").alias("edge_size"))
        at = materialize(at, "mix-edge")
    edge = at.select("__s", F.col("__prefix").alias("edge"), F.col("__rest").alias("edge_rest"), "edge_size")
    # A source without an edge has nothing left over: its rest is 0 or it has no words.
    return targets.withColumn("whole", whole).join(edge, same, "left").drop("__s")


def plan(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """One row per source: source_size, weight, target, whole, edge, edge_rest, edge_size.

    Sources in code point order, null last, take the weights in turn; together they get
    `share` times all words. `sizes` holds the helper columns and is read several times.
    """
    sources = sizes.groupBy(SOURCE).agg(F.sum(SIZE).alias("source_size"))
    ranked = positions(sources, [F.col(SOURCE).asc_nulls_last()], "rank")
    turn = F.array(*[F.lit(w) for w in weights])
    ranked = materialize(ranked.select(SOURCE, "source_size", F.get(turn, (F.col("rank") % len(weights)).cast("int")).alias("weight")), "mix-sources")
    total = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    return materialize(_edges(sizes, water_fill(ranked, total, epochs)), "mix-plan")


def _last() -> Column:
    """Words of the seeded last repetition of a row."""
    edge = F.col("edge")
    part = F.when(F.col(DRAW) == edge, F.expr(f"({SIZE} * edge_rest) div edge_size"))
    return F.when(F.col(DRAW) < edge, F.col(SIZE)).when(F.col(DRAW) == edge, part).otherwise(F.lit(0)).cast("long")


def _with_plan(rows: DataFrame, planned: DataFrame) -> DataFrame:
    planned = planned.withColumnRenamed(SOURCE, "__plan_source")
    return rows.join(planned, F.col(SOURCE).eqNullSafe(F.col("__plan_source")), "left").drop("__plan_source")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, whole, last, taken): one row for each row of docs.

    size: words of the row; target: words its source gives to the mix; the row is taken
    `whole` times and then `last` words of it once more, `taken` words together, never
    more than epochs * size. The words taken of a source are its target rounded down;
    only where rows of one id and one text meet the edge of the sample, less than a word
    of each such row is lost. Nothing depends on the order or place of rows, so reruns
    agree. Null and empty texts have size 0 and are taken with 0 words; a null source is
    a source; repeated rows and rows without an id each come back. Other columns are not
    read; an empty table gives an empty result. Each source's words fit a long, and so
    does size * edge words (9e18).
    """
    sizes = materialize(measured(docs.select("doc_id", "source", "text"), seed).drop("text"), "mix-sizes")
    joined = _with_plan(sizes, plan(sizes, weights, share, epochs))
    taken = F.col("whole") * F.col(SIZE) + F.col("last")
    out = joined.withColumn("last", _last()).withColumn("taken", taken)
    return out.select("doc_id", "source", F.col(SIZE).alias("size"), "source_size", "target", "whole", "last", "taken")


def sample(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """The mix itself: docs once for each repetition, with the column repetition (0, 1, ...).

    A repetition in part holds the first words of the text, joined by one space. Rows
    without words are left out. Columns of docs named repetition are replaced.
    """
    kept = [c for c in docs.columns if c != "repetition"]
    sizes = materialize(measured(docs.select("doc_id", "source", "text"), seed).drop("text"), "mix-sizes")
    rows = _with_plan(measured(docs.select(*kept), seed), plan(sizes, weights, share, epochs)).withColumn("__last", _last())
    times = F.col("whole") + F.when(F.col("__last") > 0, 1).otherwise(0)
    times = F.when(F.col(SIZE) > 0, times).otherwise(F.lit(0))
    each = F.explode(F.when(times > 0, F.sequence(F.lit(0).cast("long"), times - 1)))
    rows = rows.select(*kept, "whole", "__last", SIZE, each.alias("repetition"))
    partly = (F.col("repetition") == F.col("whole")) & (F.col("__last") < F.col(SIZE))
    first = bind(words(whole_text()), lambda w: F.array_join(F.slice(w, F.lit(1), F.col("__last").cast("int")), " "))
    text = F.when(partly, first).otherwise(F.col("text"))
    return rows.select(*[text.alias(c) if c == "text" else F.col(c) for c in kept], F.col("repetition").cast("int"))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  CAST('0x' || substr(md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS draw FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY source),
w AS (SELECT source, n, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS weight, 1.5::DOUBLE * (SELECT sum(n) FROM s)::DOUBLE AS total FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY n / weight::DOUBLE, source) AS k FROM w),
p AS (SELECT *, total - coalesce(sum(2.0::DOUBLE * n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS free FROM o),
l AS (SELECT arg_min(rest, k) AS rest, arg_min(free, k) AS free, min(k) AS k FROM p WHERE weight * rest / free <= 2 * n),
t AS (SELECT p.source, n, CASE WHEN p.k < l.k THEN 2.0::DOUBLE * n ELSE weight * l.rest / l.free END AS target FROM p, l),
e AS (SELECT *, CASE WHEN n > 0 THEN CAST(floor(target / n) AS BIGINT) ELSE 0 END AS whole FROM t),
f AS (SELECT *, CAST(floor(target - (whole * n)::DOUBLE) AS BIGINT) AS left_over FROM e),
r AS (SELECT d.doc_id, d.size, f.n, f.target, f.whole, f.left_over,
  sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw) AS upto, sum(d.size) OVER (PARTITION BY d.source, d.draw) AS tied
 FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, size, n AS source_size, CAST(target AS DOUBLE) AS target,
 CAST(whole * size + CASE WHEN upto <= left_over THEN size WHEN upto - tied < left_over THEN size * (left_over - (upto - tied)) // tied ELSE 0 END AS BIGINT) AS taken FROM r
"""

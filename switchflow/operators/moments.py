"""One table of moments for many linear models.

A least-squares fit needs no more of the data than the number of rows, the means and the
centred cross products of its terms. `collect_moments` sums these for the terms of all
formulas in one scan, apart for each pattern of missing values, so every formula has its
own complete rows. Parts are merged exactly (Chan, Golub and LeVeque), and every fit,
inflation factor and nested pair is then a sum over a small matrix.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows that tell where to centre the sums; any centre gives the same moments but for rounding.
HEAD = 1000


def base_columns(term: str) -> list[str]:
    """Columns that a term is made of."""
    return [term[:-2]] if term.endswith("^2") else term.split(":")


def term_column(term: str) -> Column:
    """Column of a term: a name, a square `a^2` or a product `a:b`."""
    if term.endswith("^2"):
        base = F.col(term[:-2])
        return base * base
    if ":" in term:
        a, b = term.split(":")
        return F.col(a) * F.col(b)
    return F.col(term)


@dataclass
class Moments:
    """Rows, means and centred cross products of some terms."""

    terms: list[str]
    n: int
    mean: np.ndarray
    cross: np.ndarray

    def merge(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return other if not self.n else self
        n = self.n + other.n
        apart = other.mean - self.mean
        cross = self.cross + other.cross + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(self.terms, n, self.mean + apart * (other.n / n), cross)

    def of(self, terms: Sequence[str]) -> Moments:
        at = [self.terms.index(t) for t in terms]
        return Moments(list(terms), self.n, self.mean[at], self.cross[np.ix_(at, at)])


@dataclass
class MomentTable:
    """Moments of all terms for each set of columns that rows have values in."""

    terms: list[str]
    parts: list[tuple[frozenset[str], Moments]]

    def of(self, terms: Sequence[str], whole: Sequence[str] = ()) -> Moments:
        """Moments of the terms over the rows that are complete in them, and in the terms of `whole`."""
        needed = {c for t in (*terms, *whole) for c in base_columns(t)}
        k = len(terms)
        out = Moments(list(terms), 0, np.zeros(k), np.zeros((k, k)))
        for present, moments in self.parts:
            if needed <= present:
                out = out.merge(moments.of(terms))
        return out


def collect_moments(df: DataFrame, terms: Sequence[str]) -> MomentTable:
    """Moments of the terms (names, squares `a^2`, products `a:b`) from one scan of df.

    The driver gets one row for each pattern of missing values that occurs.
    """
    terms = list(dict.fromkeys(terms))
    columns = list(dict.fromkeys(c for t in terms for c in base_columns(t)))
    known = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns]
    doubles = df.select(*[F.when(k, F.col(c).cast("double")).alias(c) for k, c in zip(known, columns)])
    values = doubles.select(
        F.concat(*[F.when(F.col(c).isNotNull(), "1").otherwise("0") for c in columns]).alias("_pattern"),
        *[term_column(t).alias(f"_t{i}") for i, t in enumerate(terms)],
    )
    k = len(terms)
    centre = [v or 0.0 for v in values.limit(HEAD).agg(*[F.avg(f"_t{i}") for i in range(k)]).first()]
    apart = values.select("_pattern", *[(F.col(f"_t{i}") - F.lit(float(c))).alias(f"_t{i}") for i, c in enumerate(centre)])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = [F.sum(f"_t{i}").alias(f"s{i}") for i in range(k)] + [F.sum(F.col(f"_t{i}") * F.col(f"_t{j}")).alias(f"p{i}_{j}") for i, j in pairs]
    parts = []
    for r in apart.groupBy("_pattern").agg(F.count(F.lit(1)).alias("n"), *sums).orderBy("_pattern").collect():
        present = frozenset(c for c, bit in zip(columns, r["_pattern"]) if bit == "1")
        shift = np.array([np.nan if r[f"s{i}"] is None else r[f"s{i}"] / r["n"] for i in range(k)])
        cross = np.full((k, k), np.nan)
        for i, j in pairs:
            if r[f"p{i}_{j}"] is not None:
                cross[i, j] = cross[j, i] = r[f"p{i}_{j}"] - r["n"] * shift[i] * shift[j]
        parts.append((present, Moments(terms, r["n"], np.array(centre) + shift, cross)))
    return MomentTable(terms, parts)

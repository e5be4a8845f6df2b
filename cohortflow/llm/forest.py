"""Nearest neighbours with a hash-prefix forest.

Every vector gets one long string of hyperplane bits per tree.  Sorted, the
strings of a tree are a prefix tree: rows that share a longer prefix with a
query stand next to it and are likelier to be near.

1. Directory: how many rows share each prefix, per tree and length, counted over
   all rows; lengths are descended eight at a time and only prefixes of at
   least ``target / (4 trees)`` rows are followed, so the directory's size
   depends on the share searched, not on the number of rows.
2. A query descends to its longest prefix in every tree and ascends in all trees
   at once until the prefixes of that length hold ``target`` rows together: the
   searched length varies with the density around the query.
3. Search: rows in blocks, queries in blocks.  A unit of work sorts its block's
   strings per tree, finds each query's prefix ranges by binary search, joins them, and
   ranks the candidates by exact distance in double precision.  Units have a
   fixed size, whatever the data's skew, and yield their best ``k`` per query.

``share`` sets the target as a share of all rows (counted once per tree).  The
default is measured (README) for vectors whose neighbours are barely
nearer than strangers, the hardest case; clustered vectors need far less.

Defined results: vectors that are null, zero or hold null or non-finite
components and rows with null ids take no part; shorter vectors are padded with
zeros; repeated ids count once (their smallest vector); ties go to the smaller id;
fewer rows than ``k`` return all of them; an empty table returns no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.vectors import dimensions, matrix, usable
from cohortflow.session import materialize

TREES, BITS = 32, 48
#: Rows searched, counted once per tree, as a share of all rows; and at least this many.
SHARE, LEAST = 0.62, 4000
#: Vectors the hyperplanes' common offset is averaged over, at most.
SAMPLE = 10_000
BLOCK, QUERY_BLOCK = 2048, 1024


class Hasher:
    """Bit strings of all trees: ``BITS`` random hyperplanes each, through the sample mean."""

    def __init__(self, dims: int, centre: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 1):
        self.dims, self.centre, self.trees, self.bits, self.seed = dims, centre, trees, bits, seed
        self.planes = None

    def strings(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees) unsigned strings, the first bit highest."""
        if self.planes is None:
            self.planes = np.random.default_rng(self.seed).standard_normal((self.dims, self.trees * self.bits)).astype(np.float32)
        side = ((x - self.centre).astype(np.float32) @ self.planes > 0).reshape(len(x), self.trees, self.bits)
        weights = np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)
        return (side * weights).sum(axis=2, dtype=np.uint64)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"planes": None}


def _prefix_counts(rows: DataFrame, hasher: Hasher, start: int, stop: int, within: set | None) -> DataFrame:
    """(tree, level, prefix, n) for prefix lengths start+1..stop, below the followed prefixes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None if within is None else [np.array(sorted(p for t, p in within if t == tree), dtype=np.uint64) for tree in range(hasher.trees)]
        total: dict[tuple, int] = {}
        for pdf in batches:
            strings = hasher.strings(matrix(pdf["embedding"], hasher.dims))
            for tree in range(hasher.trees):
                s = strings[:, tree]
                if kept is not None:
                    s = s[np.isin(s >> np.uint64(hasher.bits - start), kept[tree])]
                for level in range(start + 1, stop + 1):
                    values, n = np.unique(s >> np.uint64(hasher.bits - level), return_counts=True)
                    for v, c in zip(values.tolist(), n.tolist(), strict=True):
                        total[tree, level, v] = total.get((tree, level, v), 0) + c
        yield pd.DataFrame([(*k, c) for k, c in total.items()], columns=["tree", "level", "prefix", "n"])

    parts = rows.select("embedding").mapInPandas(run, "tree int, level int, prefix bigint, n bigint")
    return parts.groupBy("tree", "level", "prefix").agg(F.sum("n").alias("n"))


def directory(rows: DataFrame, hasher: Hasher, n_rows: int, target: int) -> dict[tuple[int, int, int], int]:
    """Row counts of the prefixes that hold at least target / (4 trees) rows."""
    least = max(1, target // (4 * hasher.trees))
    out: dict[tuple[int, int, int], int] = {}
    within, start = None, 0
    while start < hasher.bits:
        stop = min(start + 8, hasher.bits)
        # At most trees * n_rows / least rows per length: bounded by the share.
        for r in _prefix_counts(rows, hasher, start, stop, within).filter(F.col("n") >= least).collect():
            out[r["tree"], r["level"], r["prefix"]] = r["n"]
        within = {(t, p) for (t, level, p), _ in out.items() if level == stop}
        if not within:
            break
        start = stop
    return out


def searched_lengths(strings: np.ndarray, counts: dict, hasher: Hasher, target: int) -> np.ndarray:
    """Prefix length at which each query's synchronous ascent stops."""
    out = np.zeros(len(strings), dtype=np.int32)
    longest = max((level for _, level, _ in counts), default=0)
    for i, row in enumerate(strings):
        for level in range(longest, 0, -1):
            if sum(counts.get((t, level, int(s) >> (hasher.bits - level)), 0) for t, s in enumerate(row)) >= target:
                out[i] = level
                break
    return out


def _best(ids: np.ndarray, dist: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest by (distance, id)."""
    if len(dist) > k:
        limit = np.partition(dist, k - 1)[k - 1]
        at = np.flatnonzero(dist <= limit)
    else:
        at = np.arange(len(dist))
    return at[np.lexsort((ids[at], dist[at]))][:k]


def nearest(vectors: DataFrame, queries, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows found for each query.

    ``queries``: a condition on the column ``vec_id`` that picks the query rows.
    """
    clean = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("embedding")).filter(F.col("vec_id").isNotNull() & usable())
    rows = materialize(clean.groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    n_rows = rows.count()
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    if n_rows == 0:
        return vectors.sparkSession.createDataFrame([], empty)
    dims = dimensions(rows)
    sample = rows.orderBy(F.xxhash64(F.lit(5), "vec_id"), "vec_id").limit(SAMPLE).select("embedding").toPandas()
    hasher = Hasher(dims, matrix(sample["embedding"], dims).mean(axis=0))
    target = max(least, int(np.ceil(share * n_rows)))
    counts = directory(rows, hasher, n_rows, target)

    def ascend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = searched_lengths(hasher.strings(matrix(pdf["embedding"], dims)), counts, hasher, target)
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "embedding": pdf["embedding"], "length": found})

    vector_type = rows.schema["embedding"].dataType.simpleString()
    asked = materialize(rows.filter(queries).mapInPandas(ascend, f"vec_id bigint, embedding {vector_type}, length int"))
    n_blocks = -(-n_rows // BLOCK)
    n_query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select(place(n_blocks).alias("b"), every(n_query_blocks).alias("q"), "vec_id", "embedding", F.lit(None).cast("int").alias("length"))
    right = asked.select(every(n_blocks).alias("b"), place(n_query_blocks).alias("q"), "vec_id", "embedding", "length")

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        asks, base = pdf[pdf["length"].notna()], pdf[pdf["length"].isna()]
        ids, x = base["vec_id"].to_numpy(), matrix(base["embedding"], dims)
        q_ids, q, lengths = asks["vec_id"].to_numpy(), matrix(asks["embedding"], dims), asks["length"].to_numpy().astype(np.int64)
        strings, q_strings = hasher.strings(x), hasher.strings(q)
        chosen = np.zeros((len(q), len(x)), dtype=bool)
        chosen[lengths == 0] = True
        some = np.flatnonzero(lengths > 0)
        for tree in range(hasher.trees):
            order = np.argsort(strings[:, tree], kind="stable")
            column = strings[order, tree]
            drop = (hasher.bits - lengths[some]).astype(np.uint64)
            low = (q_strings[some, tree] >> drop) << drop
            first = np.searchsorted(column, low, side="left")
            last = np.searchsorted(column, low + ((np.uint64(1) << drop) - np.uint64(1)), side="right")
            for i, a, b in zip(some.tolist(), first.tolist(), last.tolist(), strict=True):
                chosen[i, order[a:b]] = True
        out_q, out_v, out_d = [], [], []
        for i in range(len(q)):
            at = np.flatnonzero(chosen[i] & (ids != q_ids[i]))
            d = np.sqrt(((x[at] - q[i]) ** 2).sum(axis=1))
            best = _best(ids[at], d, k)
            out_q.append(np.full(len(best), q_ids[i]))
            out_v.append(ids[at][best])
            out_d.append(d[best])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
        block = int(pdf["b"].iloc[0])
        return pd.DataFrame({"b": np.full(sum(map(len, out_q)), block), "query_id": join(out_q, np.int64), "vec_id": join(out_v, np.int64), "score": join(out_d, np.float64)})

    found = left.unionByName(right).groupBy("b", "q").applyInPandas(search, "b int, query_id bigint, vec_id bigint, score double")
    # Merge the blocks' lists a few dozen at a time, so no window grows with the table.
    while n_blocks > 32:
        n_blocks = -(-n_blocks // 32)
        found = found.withColumn("b", F.floor(F.col("b") / 32).cast("int"))
        w = Window.partitionBy("query_id", "b").orderBy("score", "vec_id")
        found = found.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).drop("place")
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.select("query_id", F.row_number().over(w).alias("rank"), "vec_id", "score")
    return ranked.filter(F.col("rank") <= k)

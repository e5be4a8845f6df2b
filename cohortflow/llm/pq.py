"""Embedding near-duplicates with product quantisation.

Coarse inverted lists hold each vector's residual in subspace codes; asymmetric
table lookups rule out most pairs and exact cosines in double precision decide
the rest.  Both prunings are bounds, not estimates, so no link is lost:

* Probes: unit vectors with cosine c are sqrt(2 - 2c) apart.  A vector within that
  radius of y can only lie in list l if y is within the radius of the
  bisector between l's centroid and y's own, so y probes exactly these lists.
* Codes: the table distance from y to the decoded vector is off by at most
  the vector's own quantisation error, which is stored with its code.

Equal vectors are one class from the start, counted with its rows.  A list's
members and probes are cut into blocks, one unit of work per pair of blocks, so a
hot list is many small units.  A unit yields link counts and a spanning
forest of its links, never its pairs.

Training: centroids and codebooks from at most ``SAMPLE`` vectors in hash order.

Defined results: vectors that are null, zero or hold null or non-finite
components and rows with null ids link with nothing (n_links 0, their own
component; null id: component null, kept); shorter vectors are padded with
zeros; repeated rows are vectors of their own that link with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.components import connected_components, spanning_stars
from cohortflow.llm.vectors import dimensions, matrix, usable
from cohortflow.session import materialize

#: Vectors trained on, at most; most lists; lists per square root of the classes.
#: Vectors without clusters probe most lists, so few large lists move the least.
SAMPLE, MAX_LISTS, LIST_FACTOR = 20_000, 2048, 0.125
SUBSPACES, CODES = 8, 64
#: Members and probes of one unit of work, and probes looked up at a time.
BLOCK, PROBE_BLOCK, SLICE = 2048, 4096, 512


def _lloyd(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Plain k-means; empty centroids keep their place."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = np.argmin((centres**2).sum(1)[None, :] - 2.0 * (x @ centres.T), axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


class Quantiser:
    """Coarse centroids and residual codebooks of unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, codes: int = CODES):
        self.centroids = _lloyd(sample, lists, 8, 3)
        self.width = -(-sample.shape[1] // subspaces)
        rest = self._cut(sample - self.centroids[self.own(sample)])
        self.books = [_lloyd(rest[:, s], codes, 8, 4 + s) for s in range(rest.shape[1])]

    def _cut(self, x: np.ndarray) -> np.ndarray:
        parts = -(-x.shape[1] // self.width)
        out = np.zeros((len(x), parts * self.width))
        out[:, : x.shape[1]] = x
        return out.reshape(len(x), parts, self.width)

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances to all centroids."""
        return np.maximum((x**2).sum(1)[:, None] + (self.centroids**2).sum(1)[None, :] - 2.0 * (x @ self.centroids.T), 0.0)

    def own(self, x: np.ndarray) -> np.ndarray:
        return np.argmin(self.distances(x), axis=1)

    def probes(self, x: np.ndarray, radius: float) -> list[np.ndarray]:
        """Lists that may hold a vector within ``radius``, other than the own one."""
        d = self.distances(x)
        own = np.argmin(d, axis=1)
        # Distance to the bisector: (d_l - d_own) / (2 |l - own|), with slack for rounding.
        gaps = {o: np.sqrt(((self.centroids - self.centroids[o]) ** 2).sum(1)) for o in np.unique(own).tolist()}
        out = []
        for i, o in enumerate(own.tolist()):
            near = (d[i] - d[i, o]) <= 2.0 * gaps[o] * (radius + 1e-6) + 1e-9
            near[o] = False
            out.append(np.flatnonzero(near))
        return out

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Residual codes and the quantisation error of each vector."""
        rest = self._cut(x - self.centroids[lists])
        codes = np.zeros(rest.shape[:2], dtype=np.uint8)
        error = np.zeros(len(x))
        for s, book in enumerate(self.books):
            d = (rest[:, s] ** 2).sum(1)[:, None] + (book**2).sum(1)[None, :] - 2.0 * (rest[:, s] @ book.T)
            codes[:, s] = np.argmin(d, axis=1)
            error += np.maximum(d[np.arange(len(x)), codes[:, s]], 0.0)
        return codes, np.sqrt(error)

    def table_distances(self, y: np.ndarray, one_list: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances from each y to each decoded vector of one list, by lookup."""
        rest = self._cut(y - self.centroids[one_list])
        total = np.zeros((len(y), len(codes)), dtype=np.float32)
        for s, book in enumerate(self.books):
            table = (rest[:, s] ** 2).sum(1)[:, None] + (book**2).sum(1)[None, :] - 2.0 * (rest[:, s] @ book.T)
            total += np.take(table.astype(np.float32), codes[:, s], axis=1)
        return total


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x**2).sum(axis=1))[:, None]


def _links_of_units(units: DataFrame, quantiser, dims: int, min_cosine: float) -> DataFrame:
    """(a, b, n): link counts (b null) and spanning edges (n null) of every unit.

    ``units``: list, blk, chunk, node, rows, embedding, code, error (null for a
    probe), inner (a probe of its own list).
    """
    radius = float(np.sqrt(max(2.0 - 2.0 * min_cosine, 0.0))) + 1e-6

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        q = quantiser.value
        members, probes = pdf[pdf["error"].notna()], pdf[pdf["error"].isna()]
        if not len(members) or not len(probes):
            return pd.DataFrame({"a": [], "b": [], "n": []})
        x, y = matrix(members["embedding"], dims), matrix(probes["embedding"], dims)
        uy = _unit(y)
        codes = np.frombuffer(b"".join(members["code"]), dtype=np.uint8).reshape(len(members), -1)
        # The slack covers the lookups' single precision.
        bound = ((radius + members["error"].to_numpy() + 1e-3) ** 2).astype(np.float32)
        n_x, n_y = members["node"].to_numpy(), probes["node"].to_numpy()
        inner = probes["inner"].to_numpy().astype(bool)
        norm_x, norm_y = np.sqrt((x**2).sum(1)), np.sqrt((y**2).sum(1))
        one_list = int(pdf["list"].iloc[0])
        found_i, found_j = [], []
        for at in range(0, len(y), SLICE):
            s = slice(at, at + SLICE)
            near = q.table_distances(uy[s], one_list, codes) <= bound[None, :]
            near &= ~inner[s][:, None] | (n_x[None, :] > n_y[s][:, None])  # a pair of one list once
            i, j = np.nonzero(near)
            i += at
            for part in range(0, len(i), 65_536):
                u, v = i[part : part + 65_536], j[part : part + 65_536]
                hit = (y[u] * x[v]).sum(axis=1) / (norm_y[u] * norm_x[v]) >= min_cosine
                found_i.append(u[hit])
                found_j.append(v[hit])
        i = np.concatenate(found_i) if found_i else np.zeros(0, dtype=np.int64)
        j = np.concatenate(found_j) if found_j else np.zeros(0, dtype=np.int64)
        if not len(i):
            return pd.DataFrame({"a": [], "b": [], "n": []})
        r_x, r_y = members["rows"].to_numpy(), probes["rows"].to_numpy()
        add_y = np.bincount(i, weights=r_x[j], minlength=len(y)).astype(np.int64)
        add_x = np.bincount(j, weights=r_y[i], minlength=len(x)).astype(np.int64)
        u, v = spanning_stars(n_y[i], n_x[j])
        counted = np.concatenate((n_y[add_y > 0], n_x[add_x > 0]))
        added = np.concatenate((add_y[add_y > 0], add_x[add_x > 0]))
        return pd.DataFrame(
            {
                "a": np.concatenate((counted, u)),
                "b": pd.array([None] * len(counted) + v.tolist(), dtype="Int64"),
                "n": pd.array(added.tolist() + [None] * len(u), dtype="Int64"),
            }
        )

    return units.groupBy("list", "blk", "chunk").applyInPandas(run, "a bigint, b bigint, n bigint")


def near_duplicates(vectors: DataFrame, min_cosine: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``."""
    spark = vectors.sparkSession
    node = F.when(F.col("vec_id").isNotNull() & usable(), F.xxhash64("embedding"))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("embedding")).withColumn("node", node)
    classes = materialize(
        rows.filter("node is not null").groupBy("node", "embedding").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("rows"))
    )
    n = classes.count()
    if n:
        dims = dimensions(classes)
        sample = classes.orderBy(F.xxhash64(F.lit(9), "node"), "node").limit(SAMPLE).select("embedding").toPandas()
        lists = max(1, min(MAX_LISTS, int(LIST_FACTOR * n**0.5), len(sample) // 4))
        # Bounded: MAX_LISTS centroids and the codebooks.
        quantiser = spark.sparkContext.broadcast(Quantiser(_unit(matrix(sample["embedding"], dims)), lists))
        radius = float(np.sqrt(max(2.0 - 2.0 * min_cosine, 0.0))) + 1e-6
        vector_type = classes.schema["embedding"].dataType.simpleString()

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            q = quantiser.value
            for whole in batches:
                for at in range(0, len(whole), 1000):
                    pdf = whole.iloc[at : at + 1000]
                    x = _unit(matrix(pdf["embedding"], dims))
                    own = q.own(x)
                    codes, error = q.encode(x, own)
                    # The other side of a pair probes too: lists after the own one suffice.
                    probed = [p[p > o].tolist() for p, o in zip(q.probes(x, radius), own, strict=True)]
                    yield pd.DataFrame(
                        {
                            "node": pdf["node"], "rows": pdf["rows"], "embedding": pdf["embedding"], "own": own,
                            "code": [c.tobytes() for c in codes], "error": error, "probed": probed,
                        }
                    )

        placed = materialize(classes.select("node", "rows", "embedding").mapInPandas(place, f"node bigint, rows bigint, embedding {vector_type}, own int, code binary, error double, probed array<int>"))
        member = placed.select(F.col("own").alias("list"), "node", "rows", "embedding", "code", "error", F.lit(None).cast("boolean").alias("inner"))
        slim = ["node", "rows", "embedding", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("double").alias("error")]
        inner = placed.select(F.col("own").alias("list"), *slim, F.lit(True).alias("inner"))
        outer = placed.select(F.explode("probed").alias("list"), *slim, F.lit(False).alias("inner"))
        # Blocks per list from the counts of its members and probes (one row per list).
        m = placed.groupBy(F.col("own").alias("list")).agg(F.count(F.lit(1)).alias("m"))
        p = placed.select(F.explode(F.concat(F.array("own"), "probed")).alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("p"))
        cut = m.join(p, "list").select("list", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("p") / PROBE_BLOCK).cast("int").alias("chunks"))
        cut = F.broadcast(materialize(cut))  # at most MAX_LISTS rows
        spot = lambda k: F.pmod(F.xxhash64("node"), F.col(k)).cast("int")
        every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
        columns = ["list", "blk", "chunk", "node", "rows", "embedding", "code", "error", "inner"]
        left = member.join(cut, "list").withColumn("blk", spot("blocks")).withColumn("chunk", every("chunks")).select(*columns)
        right = inner.unionByName(outer).join(cut, "list").withColumn("chunk", spot("chunks")).withColumn("blk", every("blocks")).select(*columns)
        found = materialize(_links_of_units(left.unionByName(right), quantiser, dims, min_cosine))
        counts = found.filter("n is not null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
        comps = connected_components(found.filter("b is not null"))
    else:
        counts = spark.createDataFrame([], "node bigint, n bigint")
        comps = spark.createDataFrame([], "node bigint, component bigint")
    grouped = classes.select("node", "first_id", "rows").join(comps, "node", "left").withColumn("group", F.coalesce("component", "node"))
    smallest = grouped.groupBy("group").agg(F.min("first_id").alias("smallest"))
    links = F.coalesce("n", F.lit(0)) + F.col("rows") - 1
    per_class = materialize(grouped.join(smallest, "group").join(counts, "node", "left").select("node", "smallest", links.alias("links")))
    out = rows.select("vec_id", "node").join(per_class, "node", "left")
    component = F.coalesce("smallest", "vec_id")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )

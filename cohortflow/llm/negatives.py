"""Hard negatives by inner product, found by segment summary filtering.

Components are whole numbers, floor(256 x).  Every vector is cut into segments of equal
length; per segment its mean and (population) deviation are stored.  For two vectors a, b
the inner product of a segment of length L lies within
``L (mean_a mean_b +- dev_a dev_b)`` (Cauchy-Schwarz on the centred parts), so the sums over
the segments bound the score from both sides.  Pairs whose bounds miss an anchor's window
are dropped at the coarse level, the rest is refined with shorter segments, and only what is
left is scored exactly, in whole numbers.

Rows are shuffled once, into ranges by (label, signs of the segment means, id): a row group
per range, small enough to be held by a task.  Anchors are packed and sent to the row groups
that can answer them: for positives the groups that hold the anchor's label (equi-join), for
negatives all of them.  A row group first skips the anchors that its own bounds (smallest and
largest mean, largest deviation per segment) rule out.  Each group returns its first few rows
an anchor; a window with a limit merges them.  Neither rows nor anchors are collected.

Work: anchors times rows in the worst case (vectors without any structure), less whatever the
bounds rule out; the anchors, not the rows, are copied, once per row group of at most about
``GROUP_ROWS`` rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.vectors import dimensions
from cohortflow.session import materialize

#: Rows of a row group, on average (64 components: 64 MB as doubles).
GROUP_ROWS = 1 << 17
#: Anchors that travel in one record.
PACK = 512
#: Rows that are bounded together.
CHUNK = 4096
#: Segments a vector is cut into, coarse to fine.
LEVELS = (4, 16)
_SIGNS = 8


def whole_components(col: str) -> Column:
    """floor(256 x) of every component, as doubles (exact whole numbers)."""
    return F.transform(col, lambda x: F.floor(x.cast("double") * F.lit(256.0)).cast("double"))


def _padded(dims: int) -> int:
    return -(-max(dims, 1) // LEVELS[-1]) * LEVELS[-1]


def summary(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every segment of every row."""
    cut = x.reshape(len(x), segments, -1)
    return cut.mean(axis=2), cut.std(axis=2)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix, padded with zeros."""
    out = np.zeros((len(column), width))
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    full = len(lengths) > 0 and (lengths == lengths[0]).all()
    if full:
        out[:, : lengths[0]] = flat[offsets[0] : offsets[-1]].reshape(len(column), -1)
    else:
        for i, n in enumerate(lengths.tolist()):
            out[i, :n] = flat[offsets[i] : offsets[i] + n]
    return out


class RowGroup:
    """The rows of one range with the summaries of all levels."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.levels = [summary(x, s) for s in LEVELS]
        self.largest = float(np.abs(x).max(initial=0.0))
        means, devs = self.levels[0]
        self.low, self.high, self.dev = means.min(axis=0), means.max(axis=0), devs.max(axis=0)

    def reach(self, means: np.ndarray, devs: np.ndarray) -> np.ndarray:
        """Largest score any row of the group can have, per anchor."""
        size = self.x.shape[1] // LEVELS[0]
        best = np.maximum(means * self.low, means * self.high) + devs * self.dev
        return size * best.sum(axis=1) + self.slack(means)

    def slack(self, a: np.ndarray) -> float:
        """More than the summaries' rounding can move a bound; ``a``: anchors or their means."""
        return 1.0 + 1e-9 * self.x.shape[1] * self.largest * (1.0 + float(np.abs(a).max(initial=0.0)))

    def pairs(self, a: np.ndarray, bounds: list[tuple[np.ndarray, np.ndarray]], at: int, least: np.ndarray, most: np.ndarray, fits) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of the rows ``at:at + CHUNK`` whose score lies in the anchor's window.

        ``fits(anchors, labels)``: which pairs of anchors and rows count at all.
        """
        rows = slice(at, at + CHUNK)
        x = self.x[rows]
        slack = self.slack(a)
        mask = fits(self.labels[rows])
        i, j = None, None
        for (means, devs), (a_means, a_devs), segments in zip(self.levels, bounds, LEVELS, strict=True):
            size = x.shape[1] // segments
            middle = size * _products(a_means, means[rows], i, j)
            spread = size * _products(a_devs, devs[rows], i, j) + slack
            if i is None:
                mask &= (middle + spread >= least[:, None]) & (middle - spread <= most[:, None])
                i, j = np.nonzero(mask)
            else:
                keep = (middle + spread >= least[i]) & (middle - spread <= most[i])
                i, j = i[keep], j[keep]
        exact = x.shape[1] * self.largest * float(np.abs(a).max(initial=0.0)) < 2**52
        left, right = (a, x) if exact else (a.astype(np.int64), x.astype(np.int64))
        score = _products(left, right, i, j).astype(np.int64)
        inside = (score >= least[i]) & (score <= most[i])
        return i[inside], j[inside] + at, score[inside]


def _products(a: np.ndarray, x: np.ndarray, i: np.ndarray | None, j: np.ndarray | None) -> np.ndarray:
    """Inner products of all pairs, or of the pairs (i, j): one by one if they are few."""
    if i is None:
        return a @ x.T
    if 8 * len(i) > len(a) * len(x):
        return (a @ x.T)[i, j]
    out = np.empty(len(i), dtype=a.dtype)
    for k in range(0, len(i), 1 << 16):
        few = slice(k, k + (1 << 16))
        out[few] = np.einsum("ij,ij->i", a[i[few]], x[j[few]])
    return out


def _first(key: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Indices of the first ``n`` entries of every key: higher scores first, then smaller ids."""
    order = np.lexsort((row, ids, -score, key))
    k = key[order]
    start = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, dtype=np.int64)
    place = np.arange(len(k)) - np.repeat(start, np.diff(np.append(start, len(k))))
    return order[place < n]


def _search(group: RowGroup, ids: np.ndarray, labels: np.ndarray, a: np.ndarray, windows: np.ndarray | None, n: int) -> tuple[np.ndarray, ...]:
    """First ``n`` rows of the group for every anchor.

    Without ``windows``: other rows of the anchor's label.  With them (anchors x windows x
    2, smallest and largest score): rows of other labels, first ``n`` of each window.
    Returns (anchor, window, id, score).
    """
    bounds = [summary(a, s) for s in LEVELS]
    n_windows = 1 if windows is None else windows.shape[1]
    big = np.iinfo(np.int64).max
    if windows is None:
        floor, most = np.full((len(a), 1), -big), np.full(len(a), big)
    else:
        floor, most = np.where(windows[:, :, 0] > windows[:, :, 1], big, windows[:, :, 0]), windows[:, :, 1].max(axis=1, initial=-big)
    empty = np.zeros(0, dtype=np.int64)
    key, score, found, row = empty, empty, empty, empty
    reach = group.reach(*bounds[0])
    for at in range(0, len(group.ids), CHUNK):
        least = floor.min(axis=1)
        live = np.flatnonzero((reach >= least) & (least <= most))
        if not len(live):
            continue
        if windows is None:
            fits = lambda other, own=labels[live]: own[:, None] == other[None, :]
        else:
            fits = lambda other, own=labels[live]: own[:, None] != other[None, :]
        i, j, s = group.pairs(a[live], [(m[live], d[live]) for m, d in bounds], at, least[live], most[live], fits)
        i = live[i]
        if windows is None:
            other = group.ids[j] != ids[i]
            new = [(i[other], s[other], j[other])]
        else:
            new = []
            for w in range(n_windows):
                inside = (s >= windows[i, w, 0]) & (s <= windows[i, w, 1])
                new.append((i[inside] * n_windows + w, s[inside], j[inside]))
        key = np.concatenate([key, *[x[0] for x in new]])
        score = np.concatenate([score, *[x[1] for x in new]])
        row = np.concatenate([row, *[x[2] for x in new]])
        found = group.ids[row]
        best = _first(key, score, found, row, n)
        key, score, found, row = key[best], score[best], found[best], row[best]
        # A key with n entries needs nothing below its last one from now on.
        full, count = np.unique(key, return_counts=True)
        last = np.concatenate((key[1:] != key[:-1], [True])) if len(key) else np.zeros(0, dtype=bool)
        worst = score[last][count == n]
        full = full[count == n]
        floor[full // n_windows, full % n_windows] = np.maximum(floor[full // n_windows, full % n_windows], worst)
    return key // n_windows, key % n_windows, found, score


_FOUND = "anchor_id bigint, slot int, vec_id bigint, score bigint"


def _over_groups(rows: DataFrame, packs: DataFrame, dims: int, n: int, windowed: bool, n_groups: int) -> DataFrame:
    """Send the packs to their row groups and search there: (anchor_id, slot, vec_id, score)."""
    width = _padded(dims)
    both = rows.select("g", F.lit(0).alias("kind"), F.array("vec_id").alias("ids"), F.array("label").alias("labels"), "x", F.lit(None).cast("array<bigint>").alias("windows"))
    both = both.unionByName(packs.select("g", F.lit(1).alias("kind"), "ids", "labels", "x", "windows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, group = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            g_col, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((g_col[1:] != g_col[:-1]) | (kind[1:] != kind[:-1]) | (kind[1:] == 1)) + 1
            for a, b in zip(np.concatenate(([0], cuts)).tolist(), np.append(cuts, len(g_col)).tolist(), strict=True):
                if g_col[a] != here:
                    here, held, group = g_col[a], [], None
                part = batch.slice(a, b - a)
                if kind[a] == 0:
                    held.append((part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy(), _matrix(part.column(4), width)))
                    continue
                if not held and group is None:
                    continue  # no row here: nothing to find
                if group is None:
                    group = RowGroup(*[np.concatenate(p) for p in zip(*held, strict=True)])
                    held = []
                ids, labels = part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy()
                anchors = part.column(4).flatten().to_numpy().reshape(len(ids), width)
                windows = part.column(5).flatten().to_numpy().reshape(len(ids), -1, 2) if windowed else None
                i, slot, found, score = _search(group, ids, labels, anchors, windows, n)
                yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(slot.astype(np.int32)), pa.array(found), pa.array(score)], ["anchor_id", "slot", "vec_id", "score"])

    dealt = both.repartition(n_groups, "g").sortWithinPartitions("g", "kind")
    return dealt.mapInArrow(run, _FOUND)


def _packed(anchors: DataFrame, width: int, by: list[str]) -> DataFrame:
    """Records of at most ``PACK`` anchors, packed where they lie: (by, ids, labels, x, windows)."""
    flat = [*by, "vec_id", "label", "x", "windows"]
    kinds = ", ".join(f"{c} int" for c in by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            keys = [batch.column(names.index(c)).to_numpy() for c in by]
            order = np.lexsort(keys) if keys else np.arange(batch.num_rows)
            change = np.zeros(len(order), dtype=bool)
            for k in keys:
                change[1:] |= k[order][1:] != k[order][:-1]
            cuts = np.append(np.flatnonzero(change), len(order))
            a, pieces = 0, []
            for b in cuts.tolist():
                pieces += [order[k : min(k + PACK, b)] for k in range(a, b, PACK)]
                a = b
            x = _matrix(batch.column(names.index("x")), width)
            ids, labels = batch.column(names.index("vec_id")).to_numpy(), batch.column(names.index("label")).to_numpy()
            windows = batch.column(names.index("windows"))
            for piece in pieces:
                if not len(piece):
                    continue
                w = windows.take(pa.array(piece)).flatten()
                columns = [pa.array(k[piece[:1]]) for k in keys]
                columns += [pa.array([ids[piece]]), pa.array([labels[piece]]), pa.array([x[piece].ravel()]), pa.ListArray.from_arrays(pa.array([0, len(w)], pa.int32()), w)]
                yield pa.RecordBatch.from_arrays(columns, [*by, "ids", "labels", "x", "windows"])

    schema = (kinds + ", " if by else "") + "ids array<bigint>, labels array<bigint>, x array<double>, windows array<bigint>"
    return anchors.select(*flat).mapInArrow(run, schema)


def _ranked(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def usable_rows(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, x): one row per id that takes part, components as whole numbers."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"), F.col(vec_col).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad)
    rows = rows.select("vec_id", "label", whole_components("v").alias("x"))
    # Scores are longs, and a hundred times a score too: a component must leave room for them.
    room = F.floor(F.sqrt(F.lit(float(2**55)) / F.greatest(F.size("x"), F.lit(1))))
    rows = rows.filter(~F.exists("x", lambda c: F.abs(c) > room))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("r")).select("vec_id", "r.label", "r.x")


def mine(rows: DataFrame, is_anchor, n_positives: int = 5, n_negatives: int = 3, least_percent: int = 50, most_percent: int = 95, n_groups: int | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows``: (vec_id, label, x), one row per id, see ``usable_rows``; ``is_anchor`` is a
    condition on them.  An anchor's positives are its first ``n_positives`` other rows of
    its label; each positive's negatives are the first ``n_negatives`` rows of another
    label whose score lies between ``least_percent`` and ``most_percent`` percent of the
    positive's.  First: higher scores, then smaller ids.

    Rows with a component beyond ``usable_rows``' bound (2**55 over the length, its root)
    have no long score and are not in ``rows``.  A positive with a negative score has an empty window.  An anchor without positives or
    a positive without negatives gives no row; an empty table gives none.  Vectors of
    unequal length are padded with zeros; the zero vector takes part.
    """
    spark = rows.sparkSession
    out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    rows = materialize(rows.select("vec_id", "label", "x"))
    total = rows.count()
    if not total:
        return spark.createDataFrame([], out)
    dims = dimensions(rows, "x")
    width = _padded(dims)
    n_groups = n_groups or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // GROUP_ROWS))
    step = -(-width // _SIGNS)
    sign = lambda k: (F.aggregate(F.slice("x", k * step + 1, step), F.lit(0.0), lambda s, c: s + c) >= 0).cast("int")
    key = sum((sign(k) * (1 << (_SIGNS - 1 - k)) for k in range(1, _SIGNS)), sign(0) * (1 << (_SIGNS - 1)))
    ranged = rows.withColumn("k", key).repartitionByRange(n_groups, "label", "k", "vec_id").drop("k")
    grouped = materialize(ranged.withColumn("g", F.spark_partition_id()))
    anchors = grouped.filter(is_anchor)

    # Positives: an anchor visits the groups that hold its label.
    homes = grouped.select("label", "g").distinct()
    asked = anchors.drop("g").join(homes, "label").withColumn("windows", F.lit(None).cast("array<bigint>"))
    by_group = _packed(asked, width, ["g"])
    near = _over_groups(grouped, by_group, dims, n_positives, False, n_groups)
    positives = materialize(_ranked(near, ["anchor_id"], n_positives).select("anchor_id", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    # Negatives: one window of scores per positive; an anchor visits every group.
    s = F.col("positive_score")
    none = F.array(F.lit(1).cast("bigint"), F.lit(0).cast("bigint"))
    window = F.when(s < 0, none).otherwise(F.array(F.expr(f"({least_percent} * positive_score + 99) div 100"), F.expr(f"{most_percent} * positive_score div 100")))
    windows = positives.groupBy("anchor_id").agg(F.collect_list(F.struct("slot", window.alias("w"))).alias("w"))
    # An anchor has at most n_positives windows; absent ones are empty.
    slots = [F.coalesce(F.element_at(F.map_from_entries("w"), F.lit(k + 1)), none) for k in range(n_positives)]
    windows = windows.select("anchor_id", F.flatten(F.array(*slots)).alias("windows"))
    asking = anchors.drop("g").join(windows, anchors["vec_id"] == windows["anchor_id"]).drop("anchor_id")
    everywhere = _packed(asking, width, []).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    far = _over_groups(grouped, everywhere, dims, n_negatives, True, n_groups).withColumn("slot", F.col("slot") + 1)
    best = _ranked(far, ["anchor_id", "slot"], n_negatives)
    joined = best.join(positives, ["anchor_id", "slot"])
    return joined.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def relabelled(rows: DataFrame) -> DataFrame:
    """The contract's labels: ids divisible by 7 move to the next of ten labels."""
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def oracle_sql() -> str:
    """DuckDB SQL: every anchor against every row, in whole numbers."""
    return """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
  WHERE 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE place <= 3
"""

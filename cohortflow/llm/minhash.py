"""Near-duplicate documents: one-permutation MinHash with optimal densification,
banded buckets and star-shaped candidate edges.

1. Every text becomes its set of distinct word shingles (64-bit hashes), one
   permutation's minimum per bin (empty bins borrow from a fixed random
   sequence of other bins: optimal densification) and its band hashes.
2. Documents with the same set are one class; only class representatives go
   on, so a group of exact copies costs one row.
3. A bucket of classes that share a band yields a star: edges to its smallest
   class, never all pairs.  Edges are confirmed on the full sets.
4. A star can miss a link whose ends are both unlike the centre.  Such a link
   only matters if its ends lie in different components, so the members of
   buckets that still hold several components are looked at again: small buckets
   by themselves on the full sets, members of large ones through the rarest
   shingles of each set, which leave out no similar pair.

Defined results: null or wordless texts have an empty set and link with
nothing; documents with null ``doc_id`` take no part (component_id null, kept
true); repeated rows get the result of their text, one output row each.  With
fewer words than the shingle width the whole sequence is the one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.components import connected_components, spanning_stars
from cohortflow.llm.shingles import mix, shingle_sets
from cohortflow.session import materialize

#: Bands of ROWS bins each: a pair at similarity 0.8 shares no band with
#: probability (1 - 0.8**5) ** 48 = 5e-9.
BANDS, ROWS = 48, 5
BINS = BANDS * ROWS
#: Candidates are compared by signature before their sets: equal bins among the
#: bins that either fills.  Its standard error is at most 0.026, so a pair at 0.8 falls below
#: this with probability 2e-6; where the larger set has fewer than SMALL shingles, in which two
#: of them in one bin weigh too much, the sets are compared without this test.
SIGNATURE_MIN = 0.68
SMALL = 20
_NEAR = 64  # members of a bucket that are compared with one another on their full sets
_BLOCK = 512  # sets under one shingle that are held against one another in one unit of work
_BITS = 2048  # parity bits of a set; beyond _BITS_UP_TO shingles they rule out nothing at the default threshold
_BITS_UP_TO = 4608

_SKETCH = "doc_id string, text_key bigint, n_shingles bigint, h1 bigint, h2 bigint, sig binary, bands array<bigint>"
_SETS = "h1 bigint, h2 bigint, n_shingles bigint, shingles binary"


def _borrow_order() -> np.ndarray:
    """For each bin, the order in which an empty bin visits the others."""
    rng = np.random.default_rng(20240607)
    return np.stack([rng.permutation(BINS) for _ in range(BINS)])


_ORDER = _borrow_order()
_WEIGHTS = mix(np.arange(1, ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def minima(values: np.ndarray, n_bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """One-permutation minima of a sorted set of hashes, and which bins have one."""
    sig = np.zeros(n_bins, dtype=np.uint64)
    bins = (((values >> np.uint64(32)) * np.uint64(n_bins)) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    full = np.zeros(n_bins, dtype=bool)
    full[bins[first]] = True
    sig[bins[first]] = values[first]
    return sig, full


def densified(sig: np.ndarray, full: np.ndarray) -> np.ndarray:
    """``sig`` with each empty bin filled from the first full bin of its order."""
    empty = np.flatnonzero(~full)
    if len(empty):
        order = _ORDER[empty]
        sig = sig.copy()
        sig[empty] = sig[order[np.arange(len(empty)), np.argmax(full[order], axis=1)]]
    return sig


def _bytes(sig: np.ndarray, full: np.ndarray) -> np.ndarray:
    """One byte per bin; 0 marks an empty bin."""
    return np.where(full, mix(sig) % np.uint64(255) + np.uint64(1), 0).astype(np.uint8)


def _set_keys(s: np.ndarray) -> tuple[int, int]:
    """128-bit fingerprint of a set."""
    with np.errstate(over="ignore"):
        other = np.bitwise_xor.reduce(mix(s * np.uint64(0x5851F42D4C957F2D)))
        return int(np.add.reduce(s, dtype=np.uint64).view(np.int64)), int(other.view(np.int64))


def _sketch_batch(ids: list, text_keys: list, texts: list, width: int) -> pd.DataFrame:
    sets = shingle_sets(texts, width)
    n = len(sets)
    dense = np.zeros((n, BINS), dtype=np.uint64)
    small = np.zeros((n, BINS), dtype=np.uint8)
    keys = [(0, 0)] * n
    for i, s in enumerate(sets):
        if len(s):
            sig, full = minima(s)
            dense[i] = densified(sig, full)
            small[i] = _bytes(sig, full)
            keys[i] = _set_keys(s)
    with np.errstate(over="ignore"):
        salt = np.arange(BANDS, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
        bands = mix((dense.reshape(n, BANDS, ROWS) * _WEIGHTS).sum(axis=2, dtype=np.uint64) + salt).view(np.int64)
    return pd.DataFrame(
        {
            "doc_id": ids,
            "text_key": text_keys,
            "n_shingles": [len(s) for s in sets],
            "h1": [k[0] for k in keys],
            "h2": [k[1] for k in keys],
            "sig": [x.tobytes() for x in small],
            "bands": [bands[i] if len(sets[i]) else [] for i in range(n)],
        }
    )


def _set_batch(ids: list, text_keys: list, texts: list, width: int) -> pd.DataFrame:
    sets = [s for s in shingle_sets(texts, width) if len(s)]
    keys = [_set_keys(s) for s in sets]
    return pd.DataFrame({"h1": [k[0] for k in keys], "h2": [k[1] for k in keys], "n_shingles": [len(s) for s in sets], "shingles": [s.tobytes() for s in sets]})


def text_key(text_col: str = "text") -> Column:
    """Hash of a row's text: with the id it tells apart rows that share the id."""
    return F.xxhash64(F.col(text_col).cast("string"))


def _over_texts(docs: DataFrame, id_col: str, text_col: str, batch, schema: str, width: int) -> DataFrame:
    """``batch`` over the rows of ``docs``; a batch of long texts is taken in parts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, text_keys = pdf["i"].tolist(), pdf["k"].tolist()
            texts = pdf["t"].tolist()
            at = 0
            while at < len(texts):
                part, load = [], 0
                while at < len(texts) and len(part) < 1000 and (not part or load < 2_000_000):
                    part.append(texts[at].encode("utf-8", "surrogatepass") if texts[at] else b"")
                    load += len(part[-1])
                    at += 1
                yield batch(ids[at - len(part) : at], text_keys[at - len(part) : at], part, width)

    slim = docs.select(F.col(id_col).cast("string").alias("i"), text_key(text_col).alias("k"), F.col(text_col).cast("string").alias("t"))
    return slim.mapInPandas(run, schema)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """Set fingerprint, signature and band hashes of every document."""
    # Ids travel as strings: pandas has no plain nullable long.
    return _over_texts(docs, id_col, text_col, _sketch_batch, _SKETCH, width).withColumn("doc_id", F.col("doc_id").cast("bigint"))


def _similar(min_percent: int):
    @F.pandas_udf("boolean")
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.zeros(len(a), dtype=bool)
        for i, (x, y) in enumerate(zip(a, b, strict=True)):
            p, q = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            if 100 * min(len(p), len(q)) < min_percent * max(len(p), len(q)):
                continue
            both = len(p) + len(q) - len(np.union1d(p, q))
            out[i] = 100 * both >= min_percent * (len(p) + len(q) - both)
        return pd.Series(out)

    return similar


def _share_equal(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Estimated similarity of signatures, row by row (either may be one row)."""
    either = (p | q) != 0
    return ((p == q) & either).sum(axis=-1) / np.maximum(either.sum(axis=-1), 1)


def _agreement():
    @F.pandas_udf("double")
    def agreement(a: pd.Series, b: pd.Series) -> pd.Series:
        p = np.frombuffer(b"".join(a), dtype=np.uint8).reshape(len(a), BINS)
        q = np.frombuffer(b"".join(b), dtype=np.uint8).reshape(len(b), BINS)
        return pd.Series(_share_equal(p, q), dtype="float64")

    return agreement


def _likely(edges: DataFrame, light: DataFrame, min_percent: int) -> DataFrame:
    """The edges (a, b) whose sizes and signatures allow the similarity."""
    a = light.select(F.col("rep").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa"))
    b = light.select(F.col("rep").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb"))
    sized = edges.join(a, "a").join(b, "b").filter(100 * F.least("na", "nb") >= min_percent * F.greatest("na", "nb"))
    small = sized.filter(F.greatest("na", "nb") < SMALL)
    large = sized.filter(F.greatest("na", "nb") >= SMALL)
    return large.filter(_agreement()("sa", "sb") >= SIGNATURE_MIN).select("a", "b").unionByName(small.select("a", "b"))


def _confirmed(edges: DataFrame, sets: DataFrame, min_percent: int) -> DataFrame:
    """The edges (a, b) whose full sets are similar enough."""
    full = edges.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("xa")), "a").join(
        sets.select(F.col("rep").alias("b"), F.col("shingles").alias("xb")), "b"
    )
    return full.filter(_similar(min_percent)("xa", "xb")).select("a", "b")


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of the intersections of each left set with each right set.

    Only shingles of two or more sets count; their membership matrices are
    multiplied a few thousand columns at a time.
    """
    both = left + right
    flat = np.concatenate(both)
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    values, number = np.unique(flat, return_counts=True)
    shared = values[number > 1]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    if not len(shared):
        return out
    at = np.searchsorted(shared, flat)
    known = np.flatnonzero(shared[np.minimum(at, len(shared) - 1)] == flat)
    at, owner = at[known], owner[known]
    for start in range(0, len(shared), 4096):
        here = (at >= start) & (at < start + 4096)
        member = np.zeros((len(both), min(4096, len(shared) - start)), dtype=np.float32)
        member[owner[here], at[here] - start] = 1.0
        out += member[: len(left)] @ member[len(left) :].T
    return out


def _within_buckets(members: DataFrame, min_percent: int) -> DataFrame:
    """Links between different components inside each small bucket, confirmed on full sets.

    ``members``: key, rep, comp, shingles; at most _NEAR rows a key.  A bucket yields a
    spanning forest of its links, never its pairs.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rep, comp = pdf["rep"].to_numpy(), pdf["comp"].to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in pdf["shingles"]]
        n = np.array([len(x) for x in sets])
        inter = _intersections(sets, sets).astype(np.int64)
        linked = (comp[:, None] != comp[None, :]) & (100 * inter >= min_percent * (n[:, None] + n[None, :] - inter))
        x, y = np.nonzero(np.triu(linked))
        a, b = spanning_stars(rep[x], rep[y])
        return pd.DataFrame({"a": a, "b": b})

    return members.select("key", "rep", "comp", "shingles").groupBy("key").applyInPandas(run, "a bigint, b bigint").distinct()


def _shared_shingles(reps: DataFrame, sets: DataFrame) -> DataFrame:
    """(rep, shingle, df) of the shingles that two or more of ``reps`` have; df counts them."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, raw in zip(batch.column("rep").to_pylist(), batch.column("shingles"), strict=True):
                values = np.frombuffer(raw.as_buffer(), dtype=np.int64)
                for at in range(0, len(values), 1 << 18):
                    part = values[at : at + (1 << 18)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), rep)), pa.array(part)], names=["rep", "shingle"])

    rows = reps.select("rep").join(sets.select("rep", "shingles"), "rep").mapInArrow(explode, "rep bigint, shingle bigint")
    counts = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    return rows.join(counts, "shingle").select("rep", "shingle", "df")


def parity_bits(values: np.ndarray) -> np.ndarray:
    """For each of _BITS bins, whether an odd number of the set's hashes falls into it, as words.

    Two sets differ in at least as many shingles as their bits differ.
    """
    odd = np.bincount((values >> np.uint64(53)).astype(np.int64) % _BITS, minlength=_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def _bits():
    @F.pandas_udf("binary")
    def bits(shingles: pd.Series) -> pd.Series:
        sets = (np.frombuffer(x, dtype=np.uint64) for x in shingles)
        return pd.Series([parity_bits(s).tobytes() if len(s) <= _BITS_UP_TO else b"" for s in sets])

    return bits


def _at_least_apart(left: list, right: list, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A lower bound of the number of shingles in which left[x[i]] and right[y[i]] differ (0 where a set has no bits)."""
    if not len(x):
        return np.zeros(0, dtype=np.int64)
    nothing = bytes(_BITS // 8)
    a, b = (np.frombuffer(b"".join(v or nothing for v in side), dtype=np.uint64).reshape(len(side), _BITS // 64) for side in (left, right))
    known = np.array([bool(v) for v in left])[x] & np.array([bool(v) for v in right])[y]
    out = np.zeros(len(x), dtype=np.int64)
    for at in range(0, len(x), 1 << 15):
        part = slice(at, at + (1 << 15))
        out[part] = np.bitwise_count(a[x[part]] ^ b[y[part]]).sum(axis=1, dtype=np.int64)
    return np.where(known, out, 0)


def _prefix_candidates(reps: DataFrame, sets: DataFrame, min_percent: int) -> DataFrame:
    """Pairs (a, b) of ``reps`` (rep, n_shingles, comp) in different components that may be similar.

    No similar pair is missing.  With the shingles of every set in one order, rarest first,
    two similar sets share one among the first few of each: the larger set needs
    n - ceil(t n) + 1 of them, the smaller one n - ceil(2 t / (1 + t) n) + 1.  What
    thousands of documents have in common comes last, so documents that share a template
    but not enough of it have no such shingle in common: the work does not grow with the
    square of their number.  A shingle's list of sets is cut into blocks, and each pair of
    blocks is one unit of work, which rules out by their parity bits the pairs that differ
    in too many shingles: members of a crowd just below the threshold never become rows.
    """
    p = min_percent
    n = F.col("n_shingles")
    shared = _shared_shingles(reps, sets).groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("shared"))
    # Shingles of one set only come first in the order: they take places but match nothing.
    alone = (n - F.size("shared")).cast("int")
    longer = (n - F.ceil(n * p / 100) + 1).cast("int")
    shorter = (n - F.ceil(n * (2 * p) / (100 + p)) + 1).cast("int")
    crowd_bits = sets.join(reps.select("rep"), "rep", "left_semi").select("rep", _bits()("shingles").alias("bits"))
    ranked = shared.join(reps, "rep").join(crowd_bits, "rep").withColumn("alone", alone).withColumn("front", F.slice("shared", 1, F.greatest(F.lit(0), longer - alone)))
    listed = ranked.select("rep", "comp", "n_shingles", "bits", "alone", shorter.alias("shorter"), F.posexplode("front").alias("k", "x"))
    listed = materialize(listed.select(F.col("x.shingle").alias("key"), "rep", "comp", "n_shingles", "bits", "shorter", (F.col("alone") + F.col("k")).alias("place")))
    several = listed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key", "size")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0])
        left, right = pdf[pdf["blk"] == i], pdf[pdf["blk"] == j]
        (ra, ca, na, fa, pa_), (rb, cb, nb, fb, pb) = ([side[c].to_numpy() for c in ("rep", "comp", "n_shingles", "shorter", "place")] for side in (left, right))
        na, ra, ca, fa, pa_ = (v[:, None] for v in (na, ra, ca, fa, pa_))
        near = (ca != cb) & (100 * np.minimum(na, nb) >= p * np.maximum(na, nb))
        near &= np.where(na <= nb, pa_ < fa, pb < fb)
        # Counted from here, so many shingles at most can be common to both.
        near &= (100 + p) * np.minimum(na - pa_, nb - pb) >= p * (na + nb)
        if i == j:
            near &= ra < rb
        x, y = np.nonzero(near)
        both = na[x, 0] + nb[y]
        apart = _at_least_apart(left["bits"].tolist(), right["bits"].tolist(), x, y)
        close = (100 + p) * (both - apart) >= 2 * p * both
        a, b = ra[x[close], 0], rb[y[close]]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    m = listed.join(several, "key").withColumn("blocks", F.ceil(F.col("size") / F.lit(_BLOCK)).cast("int"))
    m = m.withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    m = m.withColumn("lo", F.least("blk", "other")).withColumn("hi", F.greatest("blk", "other")).drop("other", "blocks", "size")
    # The units are many and small in bytes: a fixed number of partitions, so that they are not merged into one task.
    parts = int(m.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return m.repartition(parts, "key", "lo", "hi").groupBy("key", "lo", "hi").applyInPandas(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, min_percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked where 100 * |intersection| >= min_percent * |union| of
    their shingle sets; component_id is the smallest doc_id reachable.
    """
    return grouped_rows(docs, id_col, text_col, width, min_percent).select("doc_id", "n_shingles", "component_id", "kept")


def grouped_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, min_percent: int = 80) -> DataFrame:
    """``near_duplicates`` with ``text_key`` and ``group``: two components can have the same
    smallest id where ids repeat, but never the same group (null without an id or words)."""
    t = materialize(sketches(docs, id_col, text_col, width))
    # One class per distinct set; one row per class from here on.  Signature and
    # bands are functions of the set, so any member's will do.
    keys = ["h1", "h2", "n_shingles"]
    node = F.xxhash64(*keys)
    owned = t.filter("n_shingles > 0 and doc_id is not null")
    classes = materialize(
        owned.groupBy(*keys).agg(F.min("doc_id").alias("first_doc"), F.first("sig").alias("sig"), F.first("bands").alias("bands")).withColumn("rep", node)
    )
    light = classes.select("rep", "n_shingles", "sig")

    rows = classes.select("rep", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("rep").alias("centre"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = materialize(rows.join(buckets, "key"))
    stars = shared.filter("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    likely = materialize(_likely(stars, light, min_percent))
    # Full sets of the classes that share any band, read from their texts again.
    wanted = classes.select("rep", "first_doc").join(shared.select("rep").distinct(), "rep", "left_semi").select(F.col("first_doc").alias("wanted_id")).distinct()
    again = docs.join(wanted, F.col(id_col).cast("bigint") == F.col("wanted_id"), "left_semi")
    found = _over_texts(again, id_col, text_col, _set_batch, _SETS, width).select(node.alias("rep"), "shingles")
    sets = materialize(found.groupBy("rep").agg(F.first("shingles").alias("shingles")))
    links = materialize(_confirmed(likely, sets, min_percent))
    comps = materialize(connected_components(links))

    # Links a star cannot see: both ends unlike the centre, in different components.
    comp = F.coalesce("component", "rep")
    wide = shared.filter("size > 2")
    labelled = materialize(wide.join(comps, wide["rep"] == comps["node"], "left").select("key", "rep", "size", comp.alias("comp")))
    mixed = labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
    among = materialize(labelled.join(mixed, "key", "left_semi"))
    # Classes of large buckets are compared by their rarest shingles, all of them at once;
    # a small bucket is compared by itself unless all its classes are among those.
    crowd = among.filter(F.col("size") > _NEAR).select("rep", "comp").distinct()
    crowd = materialize(crowd.join(light.select("rep", "n_shingles"), "rep"))
    few = among.filter(F.col("size") <= _NEAR)
    open_keys = few.join(crowd.select("rep"), "rep", "left_anti").select("key").distinct()
    by_bucket = _within_buckets(few.join(open_keys, "key", "left_semi").join(sets, "rep"), min_percent)
    by_prefix = _confirmed(_prefix_candidates(crowd, sets, min_percent), sets, min_percent)
    more = materialize(by_bucket.unionAll(by_prefix))
    final = comps if more.isEmpty() else connected_components(links.unionAll(more))
    names = classes.select("rep", "first_doc", *keys)
    # A component is named by the smallest doc_id of its classes.
    joined = names.join(final, names["rep"] == final["node"], "left").withColumn("group", F.coalesce("component", "rep"))
    smallest = joined.groupBy("group").agg(F.min("first_doc").alias("component_id"))
    per_class = materialize(joined.join(smallest, "group").select("h1", "h2", "n_shingles", "component_id", "group"))
    out = t.select("doc_id", "text_key", *keys).join(per_class.withColumnRenamed("component_id", "found"), keys, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), "text_key", F.when(F.col("doc_id").isNotNull(), F.col("group")).alias("group")
    )

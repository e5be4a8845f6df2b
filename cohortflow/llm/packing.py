"""Packing into optimal length buckets and token-budget batches.

1. The global histogram of document lengths (words, or any token count) is one
   grouped aggregation of the exact lengths, whatever the longest document is.
2. Dynamic programming over the histogram chooses at most ``n_buckets`` upper
   bounds that minimise the total padding (ties: the smaller bound first), by
   divide and conquer, so no table of all pairs of lengths is built.
3. Every document goes to the smallest bound that holds it, padded to that
   bound.  Batches of ``budget // bound`` documents (at least one) form inside
   each bucket, in chunks of about ``CHUNK`` documents, so no window holds a
   whole bucket.

Nothing is cut: the last bound is the longest length.  Defined results: null
and empty texts have length 0 and are packed like others; an empty table gives
no rows; repeated rows are packed one by one; null ids sort last.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.mixing import word_count
from cohortflow.session import materialize

CHUNK = 65_536


def optimal_bounds(lengths: list[int], counts: list[int], n_buckets: int) -> list[int]:
    """Upper bounds (a subset of ``lengths``, ascending) with the least padding.

    ``lengths`` are distinct and ascending.  best[j] is the least padding of the first j+1
    lengths in k buckets; the last bucket starts after i.
    """
    n = len(lengths)
    if not n:
        return []
    size = np.array(lengths, dtype=np.int64)
    number = np.concatenate(([0], np.cumsum(np.array(counts, dtype=np.int64))))
    tokens = np.concatenate(([0], np.cumsum(np.array(counts, dtype=np.int64) * size)))
    best, back = _layer(np.zeros(n, dtype=np.int64), size, number, tokens, first_only=True)[0], []
    for _ in range(1, min(n_buckets, n)):
        best, start = _layer(np.concatenate(([0], best[:-1])), size, number, tokens)
        back.append(start)
    bounds, j = [], n - 1
    for start in reversed(back):
        bounds.append(int(size[j]))
        j = int(start[j]) - 1
        if j < 0:
            break
    if j >= 0:
        bounds.append(int(size[j]))
    return sorted(bounds)


def _layer(before: np.ndarray, size: np.ndarray, number: np.ndarray, tokens: np.ndarray, first_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(padding, start) of the best last bucket i..j for every j; the smallest i of equal ones.

    ``before[i]`` is the padding of the first i lengths.  The best i never falls as j
    grows, so the middle j of a range halves the starts of its two sides: all ranges
    of one halving are searched together, in about 2 n steps.
    """
    n = len(size)
    best, start = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    pad = lambda i, j: before[i] + size[j] * (number[j + 1] - number[i]) - (tokens[j + 1] - tokens[i])
    if first_only:
        return pad(start, np.arange(n)), start
    low, high, least, most = (np.array([x], dtype=np.int64) for x in (0, n - 1, 0, n - 1))
    while len(low):
        j = (low + high) // 2
        width = np.minimum(most, j) - least + 1
        at = np.concatenate(([0], np.cumsum(width)))[:-1]
        i = np.arange(width.sum()) - np.repeat(at - least, width)
        cost = pad(i, np.repeat(j, width))
        best[j] = np.minimum.reduceat(cost, at)
        start[j] = np.minimum.reduceat(np.where(cost == np.repeat(best[j], width), i, n), at)
        low, high, least, most = (
            np.concatenate(x) for x in ((low, j + 1), (j - 1, high), (least, start[j]), (start[j], most))
        )
        some = low <= high
        low, high, least, most = low[some], high[some], least[some], most[some]
    return best, start


def _in_buckets(lengths: DataFrame, n_buckets: int, budget: int) -> DataFrame:
    """``lengths`` with bucket, padded, chunks and per_batch of every row's length."""
    spark = lengths.sparkSession
    # D distinct lengths need D * (D - 1) / 2 tokens: at most about the square root of twice the corpus's tokens.
    histogram = lengths.groupBy(F.col("n_tokens").alias("len")).agg(F.count(F.lit(1)).alias("n")).orderBy("len").collect()
    bounds = optimal_bounds([r["len"] for r in histogram], [r["n"] for r in histogram], n_buckets)
    place = np.searchsorted(bounds, [r["len"] for r in histogram])
    members = np.bincount(place, weights=[r["n"] for r in histogram], minlength=len(bounds)).astype(int).tolist() if bounds else []
    table = [(k, b, max(1, -(-n // CHUNK)), max(1, budget // max(b, 1))) for k, (b, n) in enumerate(zip(bounds, members, strict=True))]
    buckets = spark.createDataFrame(table, "bucket int, padded bigint, chunks bigint, per_batch bigint")
    at = F.array(*[F.lit(b).cast("bigint") for b in bounds]) if bounds else F.array().cast("array<bigint>")
    bucket = F.size(F.filter(at, lambda b: b < F.col("n_tokens"))).cast("int")
    # One row per bucket: a bounded side.
    return lengths.withColumn("bucket", bucket).join(F.broadcast(buckets), "bucket")


def pack(lengths: DataFrame, n_buckets: int = 16, budget: int = 65_536) -> DataFrame:
    """(doc_id, n_tokens, bucket, padded, chunk, batch, slot) for (doc_id, n_tokens).

    ``bucket`` counts from 0 by length, ``batch`` from 0 in each (bucket, chunk), and
    ``slot`` from 0 in each batch.  Rows without an id are dealt to the chunks one by one.
    """
    rows = _in_buckets(lengths, n_buckets, budget)
    rows = rows.withColumn("chunk", F.pmod(F.coalesce("doc_id", F.monotonically_increasing_id()), "chunks").cast("bigint"))
    place = F.row_number().over(Window.partitionBy("bucket", "chunk").orderBy(F.col("doc_id").asc_nulls_last(), "n_tokens")) - 1
    rows = rows.withColumn("place", place.cast("bigint"))
    return rows.select(
        "doc_id", "n_tokens", "bucket", "padded", "chunk",
        F.floor(F.col("place") / F.col("per_batch")).cast("bigint").alias("batch"),
        (F.col("place") % F.col("per_batch")).cast("bigint").alias("slot"),
    )


def pack_documents(docs: DataFrame, n_buckets: int = 16, budget: int = 65_536) -> DataFrame:
    """``pack`` over the word counts of ``docs``; the texts are read once."""
    return pack(materialize(docs.select("doc_id", word_count("text").alias("n_tokens"))), n_buckets, budget)


def pack_mixed(docs: DataFrame, n_buckets: int = 16, budget: int = 65_536) -> DataFrame:
    """Batches of a mix, in the order in which it lies: (doc_id, text_key, copy, n_tokens,
    bucket, padded, chunk, batch, slot).

    A chunk is one partition of the scan, so batches are formed of rows that the mix put
    next to each other, in its order.  A document that the mix takes several times has a
    row per ``copy`` (from 1); a batch holds rows of one copy number only, so never two
    copies of a document.  (doc_id, text_key, copy) tells every row apart, rows that share
    an id or lack one included; ``text_key`` is the hash of the text (``xxhash64``).
    """
    narrow = docs.select("doc_id", F.xxhash64("text").alias("text_key"), word_count("text").alias("n_tokens"))
    # Written once: the order is that of one scan.
    narrow = materialize(narrow.withColumns({"chunk": F.spark_partition_id().cast("bigint"), "place": F.monotonically_increasing_id()}))
    same = Window.partitionBy("doc_id", "text_key", "n_tokens").orderBy("place")
    rows = _in_buckets(narrow.withColumn("copy", F.row_number().over(same)), n_buckets, budget)
    order = Window.partitionBy("bucket", "chunk", "copy").orderBy("place")
    rows = rows.withColumn("at", (F.row_number().over(order) - 1).cast("bigint"))
    return rows.select(
        "doc_id", "text_key", "copy", "n_tokens", "bucket", "padded", "chunk",
        F.floor(F.col("at") / F.col("per_batch")).cast("bigint").alias("batch"), (F.col("at") % F.col("per_batch")).cast("bigint").alias("slot"),
    )


def oracle_sql(n_buckets: int = 16, budget: int = 65_536) -> str:
    """The same packing in DuckDB SQL: the dynamic program over all lengths as a recursive query."""
    return f"""
WITH RECURSIVE lens AS (
  SELECT doc_id, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS n_tokens FROM documents
), hist AS (
  SELECT n_tokens AS rl, count(*) AS n, row_number() OVER (ORDER BY n_tokens) AS j FROM lens GROUP BY n_tokens
), cum AS (
  SELECT j, rl, sum(n) OVER (ORDER BY j) AS cn, sum(n * rl) OVER (ORDER BY j) AS ct FROM hist
), cost AS (
  SELECT coalesce(a.j, 0) AS i, b.j AS j,
         CAST(b.rl * (b.cn - coalesce(a.cn, 0)) - (b.ct - coalesce(a.ct, 0)) AS BIGINT) AS c
  FROM cum b, (SELECT j, cn, ct FROM cum UNION ALL SELECT 0, 0, 0) a WHERE a.j < b.j
), dp AS (
  SELECT 1 AS k, j, c, CAST(0 AS BIGINT) AS i FROM cost WHERE i = 0
  UNION ALL
  SELECT k, j, c, i FROM (
    SELECT p.k + 1 AS k, q.j, min(coalesce(p.c, 0) + q.c) AS c, arg_min(q.i, (coalesce(p.c, 0) + q.c) * 1000000 + q.i) AS i
    FROM (SELECT k, j, c FROM dp UNION ALL SELECT max(k), 0, 0 FROM dp) p JOIN cost q ON q.i = p.j
    WHERE p.k < least({n_buckets}, (SELECT count(*) FROM hist)) GROUP BY p.k + 1, q.j
  )
), walk AS (
  SELECT k, j, i FROM dp WHERE k = (SELECT max(k) FROM dp) AND j = (SELECT max(j) FROM dp)
  UNION ALL
  SELECT d.k, d.j, d.i FROM walk w JOIN dp d ON d.k = w.k - 1 AND d.j = w.i
), bounds AS (
  SELECT h.rl AS padded, row_number() OVER (ORDER BY h.rl) - 1 AS bucket,
         lag(h.rl, 1, -1) OVER (ORDER BY h.rl) AS below
  FROM walk w JOIN hist h USING (j)
), placed AS (
  SELECT r.doc_id, r.n_tokens, b.bucket, b.padded, greatest(1, {budget} // greatest(b.padded, 1)) AS per_batch,
         count(*) OVER (PARTITION BY b.bucket) AS members
  FROM lens r JOIN bounds b ON r.n_tokens > b.below AND r.n_tokens <= b.padded
), chunked AS (
  SELECT *, coalesce(doc_id, row_number() OVER ()) % CAST(ceil(members / {CHUNK}.0) AS BIGINT) AS chunk FROM placed
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY bucket, chunk ORDER BY doc_id NULLS LAST, n_tokens) - 1 AS place FROM chunked
)
SELECT doc_id, n_tokens, CAST(bucket AS INTEGER) AS bucket, CAST(padded AS BIGINT) AS padded, CAST(chunk AS BIGINT) AS chunk,
       CAST(place // per_batch AS BIGINT) AS batch, CAST(place % per_batch AS BIGINT) AS slot
FROM numbered
"""

"""Mixing sources to target weights with a hypergeometric splitting tree.

All DataFrame operations.  Only one pass reads the texts (to size them); the
mix itself is planned on a narrow table of blocks: ``MIN_BLOCKS`` of them, or one
per ``BLOCK_WORDS`` words where that is more, plus the number of sources:

1. Sources get weights 5, 2, 1, repeating, in code point order (null last) and
   share ``share`` of all words; a target stops at ``limit`` times its source's
   size and the excess is shared again by weight (closed-form water filling).
2. A source's documents fall into blocks by hash.  Whole passes of a source
   draw every block; the remainder draws blocks in a permuted order, and the
   last one only as far as the target reaches, document by document.
3. The block draws are exact source quotas.  A binary tree splits them among
   the output shards: each node sends a random subset of its draws, without
   replacement, to its left half, so the per-source counts of every shard are
   multivariate hypergeometric and add up to the quotas exactly.
4. Within a shard the draws are disjoint permuted blocks, shuffled locally.

Every random choice is a hash of fixed values: reruns and retried tasks agree.

Defined results: a null text has size 0 and takes 0 words; null ``doc_id`` and
repeated rows are mixed like any other row; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MIN_BLOCKS = 4096
#: Blocks do not grow with the corpus: the one block that a target cuts is ordered in one task.
BLOCK_WORDS = 1 << 24


def word_count(text: str | Column) -> Column:
    """Words of a text: runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, share: float = 1.5, limit: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Water filling: sources sorted by the level at which they reach their limit;
    the level is the first one at which the rest can share what is left.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    s = sizes.select("source", "source_size", weight.alias("w"))
    s = s.withColumn("cap", F.col("source_size").cast("double") * limit).withColumn("full_at", F.col("cap") / F.col("w"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    s = s.withColumn("total", F.sum("source_size").over(everything).cast("double") * share)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    # The first source that stays below its own limit sets the level (later ones compute lower levels).
    level = F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(everything)
    target = F.least(F.col("cap"), F.coalesce(level, F.col("full_at")) * F.col("w"))
    return s.select("source", "source_size", target.alias("target"))


def split_quotas(draws: DataFrame, levels: int, seed: int = 7) -> DataFrame:
    """Leaf shard of every block draw, by ``levels`` binary splits.

    Each node keeps a random half of its draws (chosen without replacement)
    for its left child and sends the others right.
    """
    out = draws.withColumn("shard", F.lit(0))
    for level in range(levels):
        node = Window.partitionBy("shard")
        pick = F.xxhash64(F.lit(seed), F.lit(level), "source", "block", "copy")
        place = F.row_number().over(node.orderBy(pick, F.col("source").asc_nulls_last(), "block", "copy"))
        half = F.floor((F.count(F.lit(1)).over(node) + 1) / 2)
        out = out.withColumn("right", (place > half).cast("int")).withColumn("shard", F.col("shard") * 2 + F.col("right")).drop("right")
    return out


def plan(sized: DataFrame, levels: int = 4, share: float = 1.5, limit: float = 2.0, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(sources, draws) for documents (doc_id, source, size, block_key).

    ``sources``: source, source_size, target, passes, rest, n_blocks.
    ``draws``: source, block, copy, whole, start, shard; a draw that is not whole
    takes the words of its block from ``start`` (words drawn before it) up to
    the source's ``rest``.
    """
    sizes = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    targets = source_targets(sizes, share, limit)
    size = F.col("source_size")
    # Zero-size sources have target 0; 1e-9 absorbs the rounding of the level.
    passes = F.when(size > 0, F.least(F.lit(int(limit)), F.floor(F.col("target") / size + F.lit(1e-9)))).otherwise(F.lit(0)).cast("int")
    grand = F.sum("source_size").over(Window.partitionBy())
    number = F.greatest(F.lit(MIN_BLOCKS), F.ceil(grand / F.lit(BLOCK_WORDS)))
    blocks = F.greatest(F.lit(1), F.ceil(size.cast("double") * number / F.greatest(grand, F.lit(1)))).cast("int")
    sources = targets.select("source", "source_size", "target", passes.alias("passes"), blocks.alias("n_blocks"))
    sources = materialize(sources.withColumn("rest", F.greatest(F.lit(0), F.round(F.col("target") - F.col("passes") * size)).cast("bigint")))

    placed = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).select(
        sized["source"], F.pmod("block_key", "n_blocks").cast("int").alias("block"), "size"
    )
    per_block = placed.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "source", "block"), "block")
    start = F.sum("block_size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("block_size")
    seq = materialize(per_block.select("source", "block", "block_size", start.alias("start")))
    info = sources.select(F.col("source").alias("s"), "passes", "rest")
    seq = seq.join(info, seq["source"].eqNullSafe(info["s"]))
    full = seq.filter("passes > 0").select("source", "block", F.explode(F.sequence(F.lit(1), "passes")).alias("copy"), F.lit(True).alias("whole"), F.lit(0).cast("bigint").alias("start"))
    extra = seq.filter("start < rest").select(
        "source", "block", (F.col("passes") + 1).alias("copy"), (F.col("start") + F.col("block_size") <= F.col("rest")).alias("whole"), "start"
    )
    draws = split_quotas(full.unionAll(extra), levels, seed)
    return sources, materialize(draws)


def block_key(id_col: str, text_col: str) -> Column:
    """Hash that places a row in a block; the same on every run."""
    return F.xxhash64(id_col, text_col)


def size_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, block_key), written once: the only pass over texts."""
    return materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), block_key(id_col, text_col).alias("block_key"))
    )


def _with_draws(d: DataFrame, sources: DataFrame, draws: DataFrame, seed: int) -> DataFrame:
    """Rows (source, size, block_key, ...) with source_size, target and ``draws``."""
    info = sources.select(F.col("source").alias("_s"), "source_size", "target", F.col("rest").alias("_rest"), F.col("n_blocks").alias("_n"))
    d = d.join(info, d["source"].eqNullSafe(info["_s"])).drop("_s").withColumn("_block", F.pmod("block_key", "_n").cast("int"))
    packed = draws.groupBy(F.col("source").alias("_s"), F.col("block").alias("_b")).agg(F.sort_array(F.collect_list(F.struct("copy", "shard", "whole", "start"))).alias("_drawn"))
    d = d.join(packed, d["source"].eqNullSafe(F.col("_s")) & (d["_block"] == F.col("_b")), "left").drop("_s", "_b")
    # One block per source is cut: its documents are taken in a permuted order.
    part = F.coalesce(F.exists("_drawn", lambda x: ~x["whole"]), F.lit(False))
    cut = Window.partitionBy("source", "_block").orderBy(F.xxhash64(F.lit(seed), "block_key"), "block_key", "size")
    cut_rows = d.filter(part).withColumn("_before", F.sum("size").over(cut.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    rows = d.filter(~part).withColumn("_before", F.lit(0).cast("bigint")).unionByName(cut_rows)

    def words(x):
        left = F.col("_rest") - x["start"] - F.col("_before")
        return F.when(x["whole"], F.col("size")).otherwise(F.greatest(F.lit(0), F.least(F.col("size"), left))).cast("bigint")

    none = F.array().cast("array<struct<copy:int,shard:int,whole:boolean,start:bigint>>")
    taken = F.transform(F.coalesce("_drawn", none), lambda x: F.struct(x["copy"].alias("copy"), x["shard"].alias("shard"), words(x).alias("words")))
    return rows.withColumn("draws", F.filter(taken, lambda x: x["words"] > 0)).drop("_drawn", "_before", "_rest", "_n", "_block")


def mixture(sized: DataFrame, levels: int = 4, share: float = 1.5, limit: float = 2.0, seed: int = 7) -> DataFrame:
    """Documents with their draws: (doc_id, source, size, block_key, source_size, target, draws).

    ``draws``: one struct (copy, shard, words) per time the mix takes the
    document; only a document where a source's target ends has fewer words
    than its size.
    """
    sources, draws = plan(sized, levels, share, limit, seed)
    return _with_draws(sized, sources, draws, seed)


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", levels: int = 4, share: float = 1.5, limit: float = 2.0, seed: int = 7) -> DataFrame:
    """The mix itself: one whole row of ``docs`` per draw, its columns unchanged,
    dealt to its shard and shuffled inside it."""
    sources, draws = plan(size_documents(docs, id_col, text_col, source_col), levels, share, limit, seed)
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(source_col).alias("source"),
        word_count(text_col).alias("size"), block_key(id_col, text_col).alias("block_key"),
    )
    drawn = _with_draws(rows, sources, draws, seed).select("row", "block_key", F.explode("draws").alias("x"))
    keyed = drawn.select("row", F.col("x.shard").alias("shard"), F.xxhash64(F.lit(seed), "block_key", "x.copy").alias("order_key"))
    return keyed.repartition("shard", F.pmod("order_key", F.lit(64))).sortWithinPartitions("shard", "order_key").select("row.*")


def shuffled_shards(mixed: DataFrame, seed: int = 7) -> DataFrame:
    """One row per draw, dealt to its shard and shuffled inside it:
    (shard, doc_id, source, copy, words, order_key)."""
    rows = mixed.select("doc_id", "source", "block_key", F.explode("draws").alias("x"))
    rows = rows.select(
        F.col("x.shard").alias("shard"), "doc_id", "source", F.col("x.copy").alias("copy"), F.col("x.words").alias("words"),
        F.xxhash64(F.lit(seed), "block_key", "x.copy").alias("order_key"),
    )
    return rows.repartition("shard", F.pmod("order_key", F.lit(64))).sortWithinPartitions("shard", "order_key")


def mix_table(docs: DataFrame, levels: int = 4, share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shards) of every document.

    ``shards`` lists what the splitting tree did with it: copy:shard:words of every
    draw, in order of the copies, joined by commas (empty: not drawn).
    """
    m = mixture(size_documents(docs), levels, share, limit)
    taken = F.aggregate("draws", F.lit(0).cast("bigint"), lambda a, x: a + x["words"])
    shards = F.array_join(F.transform("draws", lambda x: F.concat_ws(":", x["copy"], x["shard"], x["words"])), ",")
    return m.select("doc_id", "size", "source_size", "target", taken.alias("taken"), shards.alias("shards"))

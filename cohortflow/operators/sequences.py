"""Visit sequences, visit matrices and batches.

Shuffle layout of ``sequences``: events are numbered and grouped per (patient,
visit day) first, which spreads one busy patient over many tasks; the visit
number comes from the narrow (patient, day) keys only (one patient's days are
one array of longs); the final grouping is per (patient, chunk of visits).

No row grows with a patient or a visit: a row holds at most ``visits_per_row``
visits, and a visit of more than ``ENTRIES_PER_ROW`` entries is cut into numbered
pieces, each in a row of its own (``first_entry`` says where it starts).  A
visit of one piece is sorted as an array; the entries of a longer one are sorted in one
task, in a sort that spills; a visit of more than ``HOT_ROWS`` entries is sorted by
several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.operators.cohort import split_bucket
from cohortflow.operators.ordering import global_index
from cohortflow.session import materialize

VISITS_PER_ROW = 256
ENTRIES_PER_ROW = 4096
#: A visit of more entries is numbered by several tasks.
HOT_ROWS = 1 << 16


def _keep(df: DataFrame) -> list[str]:
    return ["split"] if "split" in df.columns else []


def _visit_keys(df: DataFrame) -> list[str]:
    """Keys of a visit for joins and sorts; the split comes last, since a sort by it tells few rows apart."""
    return ["admit_ms", "patient_id", *_keep(df)]


# ---------------------------------------------------------------- matrices


def visit_matrix(features: DataFrame) -> DataFrame:
    """Duplicate (visit, feature) cells summed.

    Dealt by patient and feature, which spreads a busy patient; a sum over a patient's visits
    then finds the cells of each feature together and shuffles nothing again.
    """
    k = _keep(features)
    return features.repartition("patient_id", "feature_id").groupBy(*k, "patient_id", "admit_ms", "feature_id").agg(F.sum("value").alias("value"))


def visit_numbers(df: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(split?, patient_id, admit_ms, visit_index, label?), one row per visit.

    A patient's distinct days are collected (partial sets before the shuffle)
    and numbered in time order; with ``labels`` the label is joined here, on
    one row per patient.
    """
    k = _keep(df) + ["patient_id"]
    days = df.groupBy(*k).agg(F.sort_array(F.collect_set("admit_ms")).alias("days"))
    extra = []
    if labels is not None:
        days = days.join(unique_labels(labels), k, "inner")
        extra = ["label"]
    return days.select(*k, *extra, F.posexplode("days").alias("visit_index", "admit_ms")).withColumn("visit_index", F.col("visit_index").cast("bigint"))


def unique_labels(labels: DataFrame) -> DataFrame:
    """(split?, patient_id, label); two label rows of one patient fail the job."""
    k = _keep(labels) + ["patient_id"]
    one = labels.groupBy(*k).agg(F.count(F.lit(1)).alias("_n"), F.max(F.col("is_dead").cast("int")).alias("_label"))
    message = F.concat(F.lit("more than one label for patient "), F.col("patient_id").cast("string"))
    return one.select(*k, F.when(F.col("_n") > 1, F.raise_error(message).cast("int")).otherwise(F.col("_label")).alias("label"))


def visit_index(df: DataFrame) -> DataFrame:
    """``df`` with the 0-based visit number of each row inside its patient."""
    return df.join(visit_numbers(df), _keep(df) + ["patient_id", "admit_ms"], "inner")


def visit_cells(features: DataFrame) -> DataFrame:
    """A8 + W2: (split?, patient_id, visit_index, admit_ms, feature_id, value)."""
    cells = visit_matrix(features).join(visit_numbers(features), _visit_keys(features), "inner")
    return cells.select(*_keep(features), "patient_id", "visit_index", "admit_ms", "feature_id", "value")


def num_features(features: DataFrame) -> DataFrame:
    """Feature-space width = largest (training) feature id + 1."""
    return features.agg((F.max("feature_id") + 1).cast("bigint").alias("num_features"))


# ---------------------------------------------------------------- sequences


def visit_sizes(features: DataFrame) -> DataFrame:
    """(split?, patient_id, admit_ms, n_rows): one narrow row per visit."""
    return features.groupBy(*_keep(features), "patient_id", "admit_ms").agg(F.count(F.lit(1)).alias("n_rows"))


def visits(features: DataFrame, entries_per_row: int = ENTRIES_PER_ROW, sizes: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """A5 + P13: (split?, patient_id, admit_ms, piece, visit): sorted (id, value) pairs.

    ``piece`` numbers the parts of a visit of more than ``entries_per_row`` entries.  With
    ``sizes`` (``visit_sizes`` as a stage table) the entries of a visit of more than
    ``hot_rows`` are numbered on two levels: range pieces of the visit are numbered each in
    its own task, and offsets come from a table with one row per piece.  Visits of one
    piece need no numbers; all others are numbered in a window each.
    """
    k = _visit_keys(features)
    rows = features.select(*k, F.col("feature_id").cast("bigint").alias("feature_id"), F.col("value").cast("double").alias("value"))
    w = Window.partitionBy(*k).orderBy("feature_id", "value")
    if sizes is None:
        return _pieces(rows.withColumn("_pos", (F.row_number().over(w) - 1).cast("bigint")), k, entries_per_row)
    out = None
    large = sizes.filter(F.col("n_rows") > F.lit(min(hot_rows, entries_per_row)))
    is_hot = F.col("n_rows") > F.lit(hot_rows)
    hot, longer = large.filter(is_hot).select(*k), large.filter(~is_hot).select(*k)
    if not hot.isEmpty():
        # The row number parts equal entries, so that no tie falls to one task.
        busy = rows.join(hot, k, "left_semi").withColumn("_row", F.monotonically_increasing_id())
        busy = global_index(busy, [F.col(c) for c in (*k, "feature_id", "value", "_row")], "_at")
        starts = materialize(busy.groupBy(*k).agg(F.min("_at").alias("_start")))  # one row per hot visit
        busy = busy.join(starts, k).select(*k, "feature_id", "value", (F.col("_at") - F.col("_start")).alias("_pos"))
        out = _pieces(busy, k, entries_per_row)
    if not longer.isEmpty():
        part = _pieces(rows.join(longer, k, "left_semi").withColumn("_pos", (F.row_number().over(w) - 1).cast("bigint")), k, entries_per_row)
        out = part if out is None else out.unionByName(part)
    calm = rows if out is None else rows.join(large.select(*k), k, "left_anti")
    # Dealt by visit first: collecting before the shuffle would merge next to nothing.
    whole = calm.repartition(*k).groupBy(*k).agg(F.sort_array(F.collect_list(F.struct("feature_id", "value"))).alias("visit"))
    whole = whole.select(*k, F.lit(0).cast("bigint").alias("piece"), "visit")
    return whole if out is None else whole.unionByName(out)


def _pieces(numbered: DataFrame, k: list[str], entries_per_row: int) -> DataFrame:
    """Visits of numbered entries (``_pos``), cut into pieces of ``entries_per_row``."""
    pair = F.struct("_pos", F.struct("feature_id", "value").alias("pair"))
    grouped = numbered.groupBy(*k, F.floor(F.col("_pos") / F.lit(entries_per_row)).cast("bigint").alias("piece")).agg(F.sort_array(F.collect_list(pair)).alias("_v"))
    return grouped.select(*k, "piece", F.transform("_v", lambda x: x["pair"]).alias("visit"))


def sequences(
    features: DataFrame,
    visits_per_row: int = VISITS_PER_ROW,
    entries_per_row: int = ENTRIES_PER_ROW,
    labels: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(split?, patient_id, chunk, first_visit, first_entry, seq, label?).

    ``seq`` is ``array<array<struct<feature_id, value>>>``: consecutive visits
    from ``first_visit`` on.  A row with ``first_entry`` > 0 holds one visit, from
    that entry on.  With ``labels`` (J7) the patient's label is attached; patients
    without one drop out.
    """
    k = _keep(features) + ["patient_id"]
    sizes = materialize(visit_sizes(features))
    v = visits(features, entries_per_row, sizes, hot_rows).join(visit_numbers(sizes, labels), _visit_keys(features), "inner")
    lab = ["label"] if labels is not None else []
    v = v.withColumn("chunk", F.floor(F.col("visit_index") / F.lit(visits_per_row)).cast("bigint"))
    own = F.when(F.col("piece") > 0, F.col("visit_index")).otherwise(F.lit(-1)).alias("_own")
    ordered = F.sort_array(F.collect_list(F.struct("visit_index", "visit")))
    return v.groupBy("patient_id", "chunk", "piece", own, *_keep(features), *lab).agg(ordered.alias("_v")).select(
        *k,
        "chunk",
        F.col("_v")[0]["visit_index"].alias("first_visit"),
        (F.col("piece") * F.lit(entries_per_row)).cast("bigint").alias("first_entry"),
        F.transform("_v", lambda x: x["visit"]).alias("seq"),
        *lab,
    )


def sequence_entries(seqs: DataFrame) -> DataFrame:
    """Long form of sequences: one row per (visit, pair); flatten(seqs) = features."""
    k = [c for c in seqs.columns if c in ("split", "label")]
    v = seqs.select(*k, "patient_id", "first_visit", "first_entry", F.posexplode("seq").alias("vpos", "visit"))
    e = v.select(
        *k,
        "patient_id",
        (F.col("first_visit") + F.col("vpos")).cast("bigint").alias("visit_index"),
        "first_entry",
        F.posexplode("visit").alias("entry_index", "pair"),
    )
    return e.select(
        *k, "patient_id", "visit_index", (F.col("entry_index") + F.col("first_entry")).cast("bigint").alias("entry_index"),
        F.col("pair.feature_id").alias("feature_id"), F.col("pair.value").alias("value"),
    )


def last_visit(seq) -> Column:
    """The last visit of a sequence."""
    return F.element_at(F.col(seq) if isinstance(seq, str) else seq, -1)


def visit_count(seq) -> Column:
    """Sequence length in visits."""
    return F.size(F.col(seq) if isinstance(seq, str) else seq)


def sequence_summary(seqs: DataFrame) -> DataFrame:
    """W5 + W6 per patient over all rows: visits, last-visit size, entries."""
    k = [c for c in seqs.columns if c in ("split", "label")]
    per_row = seqs.select(
        *k,
        "patient_id",
        F.when(F.col("first_entry") == 0, visit_count("seq")).otherwise(F.lit(0)).alias("n"),
        (F.col("first_visit") + visit_count("seq") - 1).alias("last"),
        F.size(last_visit("seq")).alias("last_n"),
        F.aggregate("seq", F.lit(0), lambda acc, x: acc + F.size(x)).alias("entries"),
    )
    # Pieces of the last visit add up.
    by_last = per_row.groupBy(*k, "patient_id", "last").agg(F.sum("n").alias("n"), F.sum("last_n").alias("last_n"), F.sum("entries").alias("entries"))
    return by_last.groupBy(*k, "patient_id").agg(
        F.sum("n").cast("bigint").alias("n_visits"),
        F.max_by("last_n", "last").cast("bigint").alias("last_visit_size"),
        F.sum("entries").cast("bigint").alias("n_entries"),
    )


# ---------------------------------------------------------------- vectors


def sparse_parts(width: int, ids, values) -> Column:
    """The fields of a sparse vector of ``width``; ids are sorted and unique (summed cells), as it needs."""
    return F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(width).alias("size"), ids.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values"))


def as_vectors(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a stage table whose column ``name`` (``sparse_parts``) is read back as vectors.

    Spark stores a vector as these fields, so no row passes through Python.
    """
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import StructField, StructType

    return materialize(df, StructType([StructField(f.name, VectorUDT()) if f.name == name else f for f in df.schema.fields]))


def in_width(width: int) -> Column:
    """``feature_id``, failing the job where it is outside the vector width."""
    message = F.concat(F.lit(f"feature id outside the width {width}: "), F.col("feature_id").cast("string"))
    inside = (F.col("feature_id") >= 0) & (F.col("feature_id") < F.lit(width))
    return F.when(inside, F.col("feature_id")).otherwise(F.raise_error(message).cast("bigint"))


def assembled(cells: DataFrame, keys: list[str], width: int, name: str) -> DataFrame:
    """(keys, name): the cells of each key as the fields of a sparse vector."""
    pairs = F.sort_array(F.collect_list(F.struct(in_width(width).alias("feature_id"), "value")))
    # The split last, as in ``_visit_keys``.
    grouped = cells.groupBy(*sorted(keys, key=lambda c: c == "split")).agg(pairs.alias("_p"))
    return grouped.select(*keys, sparse_parts(width, F.col("_p.feature_id"), F.col("_p.value")).alias(name))


def visit_vectors(cells: DataFrame, width: int) -> DataFrame:
    """One sparse vector of ``width`` per visit (never densified).

    A visit's cells are bounded by the vocabulary width, so the per-visit
    collect is bounded.  ``width`` is the vocabulary's; an id outside it is an
    error, never a silent drop.
    """
    return as_vectors(assembled(cells, _keep(cells) + ["patient_id", "visit_index"], width, "features"), "features")


def visit_ages(cells: DataFrame, age: str = "visits") -> DataFrame:
    """(split?, patient_id, admit_ms, age): how far every visit lies before the patient's last one.

    ``visits`` counts the visits after it, ``days`` the days between.  One narrow row per
    visit; partial sets and maxima before the shuffle, no window.
    """
    k = _keep(cells) + ["patient_id"]
    days = cells.groupBy(*k).agg(F.sort_array(F.collect_set("admit_ms")).alias("_days"))
    each = days.select(*k, F.element_at("_days", -1).alias("_last"), F.size("_days").alias("_n"), F.posexplode("_days").alias("_i", "admit_ms"))
    if age == "visits":
        found = (F.col("_n") - F.lit(1) - F.col("_i")).cast("double")
    elif age == "days":
        found = (F.col("_last") - F.col("admit_ms")) / F.lit(86_400_000.0)
    else:
        raise ValueError(f"unknown age {age!r}")
    return each.select(*k, "admit_ms", found.alias("age"))


def decayed_pool(cells: DataFrame, half_life: float = 2.0, age: str = "visits") -> DataFrame:
    """X3 with the order of visits: a cell counts 2 ** (-age / half_life), summed over visits.

    This is the state of the linear recurrence ``state = state * 2 ** (-gap / half_life) +
    visit``, run over a patient's visits in time order.  The recurrence is associative, so
    it is a weighted sum: the weight depends on the visit's age alone and the sum is a
    partial aggregation, however many visits a patient has.
    """
    if not half_life > 0:
        raise ValueError("half_life must be positive")
    k = _keep(cells) + ["patient_id"]
    aged = cells.join(visit_ages(cells, age), _visit_keys(cells))
    weight = F.pow(F.lit(2.0), -F.col("age") / F.lit(float(half_life)))
    return aged.groupBy(*k, "feature_id").agg(F.sum(F.col("value") * weight).alias("value"))


def pool_sequences(cells: DataFrame, how: str = "sum", sum_digits: int | None = None) -> DataFrame:
    """Patient-level pooled cells (split?, patient_id, feature_id, value).

    ``cells`` is the visit matrix (visits told apart by ``admit_ms``; visit numbers
    are not needed).  ``sum`` adds a feature over all visits, ``mean`` divides by
    the patient's number of visits, ``last`` keeps the cells of the latest visit, ``decay``
    lets older visits count less (``decayed_pool``), so that it depends on their order.
    With ``sum_digits`` the mean divides the sum rounded (half up) to that many
    decimals, which makes it independent of the order the sum was taken in.
    """
    k = _keep(cells) + ["patient_id"]
    if how == "sum":
        return cells.groupBy(*k, "feature_id").agg(F.sum("value").alias("value"))
    if how == "mean":
        n = cells.groupBy(*k).agg(F.size(F.collect_set("admit_ms")).alias("_n"))
        s = cells.groupBy(*k, "feature_id").agg(F.sum("value").alias("_s"))
        if sum_digits is not None:
            scale = float(10**sum_digits)
            s = s.withColumn("_s", F.floor(F.col("_s") * F.lit(scale) + F.lit(0.5)) / F.lit(scale))
        return s.join(n, k).select(*k, "feature_id", (F.col("_s") / F.col("_n")).alias("value"))
    if how == "last":
        last = cells.groupBy(*k).agg(F.max("admit_ms").alias("admit_ms"))
        return cells.join(last, k + ["admit_ms"], "left_semi").select(*k, "feature_id", "value")
    if how == "decay":
        return decayed_pool(cells)
    raise ValueError(f"unknown pooling {how!r}")


def patient_vectors(pooled: DataFrame, width: int, name: str = "features") -> DataFrame:
    """Sparse vector per patient from pooled cells (bounded by the width)."""
    return as_vectors(assembled(pooled, _keep(pooled) + ["patient_id"], width, name), name)


# ---------------------------------------------------------------- batches


def shuffle_key(key: str = "patient_id", seed: int = 0) -> Column:
    """A seeded pseudo-random order key (md5), stable across runs."""
    return split_bucket(key, seed)


def shuffle_rows(df: DataFrame, seed: int = 0, key: str = "patient_id") -> DataFrame:
    """``shuffle_rank`` = position in a seeded order, ties broken by key."""
    k = _keep(df)
    return global_index(
        df.withColumn("_sk", shuffle_key(key, seed)), [F.col(c) for c in k] + [F.col("_sk"), F.col(key)], "shuffle_rank"
    ).drop("_sk")


def assign_batches(df: DataFrame, size: int = 64, seed: int | None = None, key: str = "patient_id") -> DataFrame:
    """``batch_id`` and ``position`` for consecutive runs of ``size`` rows.

    Rows (one per ``key``, per split when the data carries one) are taken in
    key order, or in a seeded shuffled order when ``seed`` is given.  The
    numbering is a distributed global index over the narrow key table only;
    the batch ids are then joined back, so wide rows (sequences) are never
    range-partitioned or written just to be numbered.
    """
    k = _keep(df)
    keys = df.select(*k, key).distinct()
    if seed is None:
        order = [F.col(c) for c in k] + [F.col(key)]
    else:
        keys = keys.withColumn("_sk", shuffle_key(key, seed))
        order = [F.col(c) for c in k] + [F.col("_sk"), F.col(key)]
    idx = global_index(keys, order, "_gidx")
    if k:
        # One row per split: a bounded side.
        start = idx.groupBy(*k).agg(F.min("_gidx").alias("_start"))
        idx = idx.join(F.broadcast(start), k).withColumn("_gidx", F.col("_gidx") - F.col("_start")).drop("_start")
    ids = idx.select(
        *k,
        key,
        F.floor(F.col("_gidx") / F.lit(size)).cast("bigint").alias("batch_id"),
        (F.col("_gidx") % F.lit(size)).cast("bigint").alias("position"),
    )
    return df.join(ids, k + [key], "inner")


def batch_slots(lengths: DataFrame) -> DataFrame:
    """O3: slot, length and padded length of every patient of a batch.

    ``lengths``: (split?, patient_id, label?, length, batch_id, position), one narrow
    row per patient.  Inside a batch the longest comes first (stable); the
    padded length is the batch's longest.
    """
    k = _keep(lengths)
    w_slot = Window.partitionBy(*k, "batch_id").orderBy(F.desc("length"), F.asc("position"))
    w_all = Window.partitionBy(*k, "batch_id")
    return lengths.withColumn("slot", (F.row_number().over(w_slot) - 1).cast("bigint")).withColumn(
        "padded_length", F.max("length").over(w_all).cast("bigint")
    )


def pad_batches(entries: DataFrame, slots: DataFrame) -> DataFrame:
    """Padded batches in long form, one row per (slot, step, entry).

    ``entries``: long-form sequence entries; ``slots``: ``batch_slots``.  A step past a
    patient's last visit is one row with null feature and value 0 (an all-zero
    visit), so padding never widens a row.
    """
    k = _keep(slots)
    lead = [*k, "batch_id", "position", "slot", "patient_id", *[c for c in ("label",) if c in slots.columns], "length", "padded_length"]
    real = entries.select(*k, "patient_id", F.col("visit_index").alias("step"), "entry_index", "feature_id", "value")
    real = real.join(slots, k + ["patient_id"], "inner").select(*lead, "step", "entry_index", "feature_id", "value")
    steps = slots.filter("padded_length > length").withColumn("step", F.explode(F.sequence(F.col("length"), F.col("padded_length") - 1)))
    pad = steps.select(
        *lead, "step", F.lit(0).cast("bigint").alias("entry_index"), F.lit(None).cast("bigint").alias("feature_id"), F.lit(0.0).alias("value")
    )
    return real.unionByName(pad)


def padded_arrays(padded: DataFrame, steps_per_row: int = VISITS_PER_ROW, entries_per_row: int = ENTRIES_PER_ROW) -> DataFrame:
    """X2 in array form: (split?, batch_id, ..., padded_length, first_step, first_entry, steps).

    ``padded``: the long form of ``pad_batches``.  ``steps`` is ``array<array<struct<feature_id,
    value>>>``, the consecutive steps from ``first_step`` on; a slot's rows together have
    ``padded_length`` steps, an added step being one entry of null and 0.  A row holds at most
    ``steps_per_row`` steps of at most ``entries_per_row`` entries; the rest of a longer step
    stands in rows of its own (``first_entry`` > 0), so no row grows with a patient.
    """
    lead = [c for c in padded.columns if c not in ("step", "entry_index", "feature_id", "value")]
    piece = F.floor(F.col("entry_index") / F.lit(entries_per_row)).cast("bigint")
    entry = F.struct("entry_index", F.struct("feature_id", "value").alias("pair"))
    steps = padded.groupBy(*lead, "step", piece.alias("_piece")).agg(F.sort_array(F.collect_list(entry)).alias("_e"))
    steps = steps.select(*lead, "step", "_piece", F.transform("_e", lambda x: x["pair"]).alias("_entries"))
    own = F.when(F.col("_piece") > 0, F.col("step")).otherwise(F.lit(-1)).alias("_own")
    group = F.floor(F.col("step") / F.lit(steps_per_row)).cast("bigint").alias("_group")
    rows = steps.groupBy(*lead, group, "_piece", own).agg(F.sort_array(F.collect_list(F.struct("step", "_entries"))).alias("_s"))
    return rows.select(
        *lead, F.col("_s")[0]["step"].alias("first_step"), (F.col("_piece") * F.lit(entries_per_row)).cast("bigint").alias("first_entry"),
        F.transform("_s", lambda x: x["_entries"]).alias("steps"),
    )


def flat_arrays(arrays: DataFrame) -> DataFrame:
    """The long form of ``padded_arrays``."""
    lead = [c for c in arrays.columns if c not in ("first_step", "first_entry", "steps")]
    s = arrays.select(*lead, "first_step", "first_entry", F.posexplode("steps").alias("_i", "_step"))
    e = s.select(*lead, (F.col("first_step") + F.col("_i")).cast("bigint").alias("step"), "first_entry", F.posexplode("_step").alias("_j", "_pair"))
    return e.select(*lead, "step", (F.col("first_entry") + F.col("_j")).cast("bigint").alias("entry_index"), "_pair.feature_id", "_pair.value")

"""Document fingerprints: threshold-scaled sketches of byte shingles.

The shingles of a text are its distinct stretches of ``WIDTH`` bytes (UTF-8); a shorter
text is one shingle.  A shingle's 64-bit hash is kept if it lies below a fixed fraction
of the hash range (``1 / SCALE``), so a long text keeps more hashes than a short one, the
sketch of a union is the union of the sketches, and containment can be estimated between
very unequal texts.  A text with fewer than ``FLOOR`` hashes below the fraction keeps its
``FLOOR`` smallest ones instead (all, if it has fewer): its own threshold is the largest
hash kept.  Two sketches are compared below the smaller of their thresholds, where both
are complete, so estimates stay unbiased by the floor.

A fingerprint is a string: the kind (``f`` fixed fraction, ``k`` smallest hashes, ``a``
all hashes, ``-`` no text) and the hashes in ascending order, base64 of 8 bytes each.
Equal texts have equal fingerprints.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.shingles import mix

WIDTH = 8
SCALE = 32
FLOOR = 64
_TOP = (1 << 64) - 1
_LIMIT = _TOP // SCALE
_BUFFER = 1 << 20
#: Rows sharing one call of the hash function, at most so many bytes of text.
_TOGETHER = 1 << 22


def _window_hashes(raw: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of every stretch of ``width`` (8 to 16) bytes."""
    n = len(raw) - width + 1
    words = np.zeros(len(raw) - 7, dtype=np.uint64)
    for k in range(8):  # every stretch of 8 bytes as a number
        words |= raw[k : len(raw) - 7 + k].astype(np.uint64) << np.uint64(8 * k)
    with np.errstate(over="ignore"):
        return mix(mix(words[:n]) + words[width - 8 : width - 8 + n] * np.uint64(0x9E3779B97F4A7C15))


def sketch_all(texts: list[bytes]) -> list[tuple[str, np.ndarray]]:
    """(kind, ascending distinct hashes) of every text.  Memory: the longest text's hashes kept."""
    out: list[tuple[str, np.ndarray] | None] = [None] * len(texts)
    parts: list[list[np.ndarray]] = [[] for _ in texts]
    pieces: list[tuple[int, bytes]] = []
    held = 0

    def flush() -> None:
        nonlocal pieces, held
        raw = np.frombuffer(b"".join(p for _, p in pieces), dtype=np.uint8)
        hashes = _window_hashes(raw, WIDTH)
        low = np.flatnonzero(hashes < np.uint64(_LIMIT))
        lengths = np.array([len(p) for _, p in pieces])
        ends = np.cumsum(lengths)
        piece = np.searchsorted(ends, low, side="right")
        whole = low + WIDTH <= ends[piece]  # not across two pieces
        kept, piece = hashes[low[whole]], piece[whole]
        cuts = np.searchsorted(piece, np.arange(len(pieces) + 1))
        for j, (i, p) in enumerate(pieces):
            found = kept[cuts[j] : cuts[j + 1]]
            parts[i].append(found)
            # A short or unlucky text needs the hashes above the fraction too.
            if len(p) == len(texts[i]) and len(found) < 4 * FLOOR and len(found := np.unique(found)) < FLOOR:
                a = int(ends[j] - lengths[j])
                every = np.unique(hashes[a : a + len(p) - WIDTH + 1])
                out[i] = ("k", every[:FLOOR]) if len(every) > FLOOR else ("a", every)
        pieces, held = [], 0

    for i, text in enumerate(texts):
        if not text:
            out[i] = ("-", np.zeros(0, dtype=np.uint64))
        elif len(text) < WIDTH:
            padded = np.frombuffer(text + bytes(16 - len(text)), dtype=np.uint64)
            out[i] = ("a", mix(mix(padded[:1]) + padded[1:] + np.uint64(len(text))))
        else:
            for at in range(0, len(text) - WIDTH + 1, _BUFFER):
                pieces.append((i, text[at : at + _BUFFER + WIDTH - 1]))
                held += len(pieces[-1][1])
                if held >= _BUFFER:
                    flush()
    if pieces:
        flush()
    for i, text in enumerate(texts):
        if out[i] is None:
            found = np.unique(np.concatenate(parts[i]))
            if len(found) >= FLOOR:
                out[i] = ("f", found)
            else:  # a text of several pieces with few distinct hashes below the fraction
                every = np.zeros(0, dtype=np.uint64)
                for at in range(0, len(text) - WIDTH + 1, _BUFFER):
                    raw = np.frombuffer(text[at : at + _BUFFER + WIDTH - 1], dtype=np.uint8)
                    every = np.unique(np.concatenate((every, _window_hashes(raw, WIDTH))))[: FLOOR + 1]
                out[i] = ("k", every[:FLOOR]) if len(every) > FLOOR else ("a", every)
    return out


def encode(sketch: tuple[str, np.ndarray]) -> str:
    """The fingerprint string of a sketch."""
    kind, hashes = sketch
    return kind + base64.b64encode(hashes.astype("<u8").tobytes()).decode()


def decode(fingerprint: str) -> tuple[str, np.ndarray]:
    """The sketch of a fingerprint string."""
    return fingerprint[0], np.frombuffer(base64.b64decode(fingerprint[1:]), dtype="<u8").astype(np.uint64)


def threshold(sketch: tuple[str, np.ndarray]) -> int:
    """Every shingle hash of the text up to this one is in the sketch."""
    kind, hashes = sketch
    return _LIMIT - 1 if kind == "f" else int(hashes[-1]) if kind == "k" else _TOP


def merge(a: tuple[str, np.ndarray], b: tuple[str, np.ndarray]) -> tuple[str, np.ndarray]:
    """The sketch of both shingle sets together."""
    if a[0] == "-" or b[0] == "-":
        return a if b[0] == "-" else b
    top = min(threshold(a), threshold(b))
    every = np.union1d(a[1], b[1])
    every = every[every <= np.uint64(top)]
    low = every[every < np.uint64(_LIMIT)]
    if top >= _LIMIT - 1 and len(low) >= FLOOR:
        return "f", low
    if top == _TOP and len(every) <= FLOOR:
        return "a", every
    if len(every) >= FLOOR:
        return "k", every[:FLOOR]
    raise AssertionError("a sketch of kind 'f' or 'k' has at least FLOOR hashes")


def compare(a: tuple[str, np.ndarray], b: tuple[str, np.ndarray]) -> tuple[float, float | None, float | None]:
    """Estimated Jaccard similarity, share of a's shingles in b, share of b's in a.

    Two texts without shingles are alike (1), one without is unlike any other (0); a
    share is null where nothing of the text lies below the common threshold.
    """
    if a[0] == "-" or b[0] == "-":
        return (1.0 if a[0] == b[0] else 0.0), None, None
    top = np.uint64(min(threshold(a), threshold(b)))
    x, y = a[1][: np.searchsorted(a[1], top, side="right")], b[1][: np.searchsorted(b[1], top, side="right")]
    both = len(np.intersect1d(x, y, assume_unique=True))
    either = len(x) + len(y) - both
    return both / either if either else 0.0, both / len(x) if len(x) else None, both / len(y) if len(y) else None


_SKETCH = "doc_id bigint, n_chars bigint, fingerprint string"


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row, null texts as empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t.as_py() or "") for t in batch.column(1)]
            prints = [encode(s) for s in sketch_all([t.encode("utf-8", "surrogatepass") for t in texts])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(prints, pa.string())], ["doc_id", "n_chars", "fingerprint"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, _SKETCH)


def _parts(ids: DataFrame, n_parts: int) -> tuple[Bucketizer, list[tuple[int, int]]]:
    """Ranges of ids with about equally many rows, and the first id of every range that has any.

    Both lists have at most ``n_parts`` entries; the ids stay in Spark.
    """
    cuts = ids.approxQuantile("id", [k / n_parts for k in range(1, n_parts)], 0.25 / n_parts) if n_parts > 1 else []
    splits = [-float("inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    split = Bucketizer(splits=splits, inputCol="id", outputCol="part")
    firsts = split.transform(ids).groupBy("part").agg(F.min("doc_id").alias("first")).collect()
    return split, sorted((int(r["part"]), r["first"]) for r in firsts)


_EDITED = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, kept_share double, next_share double"


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_parts: int | None = None) -> DataFrame:
    """Fingerprint of every document, of its edited text, and their likeness.

    The edited text: the last floor(n_chars / 2) code points are replaced by the first as
    many (or all) of the next document by ascending id; the last document's next one is
    the first.  ``near_edited`` and ``near_next``: estimated Jaccard similarity to the
    edited text and to the next document; ``kept_share``: share of the document's shingles
    in the edited text; ``next_share``: share of the next document's shingles in the
    document.

    Rows are dealt by ranges of ids and sorted there, one shuffle; the first rows of a
    range are sent to the range before as well, where they end the range.  Rows that share
    an id come in the order of a hash of their text.  A row without an id has no place in
    the order: nothing replaces its last half, its next text counts as empty, and it is no
    row's next.  Null texts are empty.  Other columns are not read.
    """
    spark = docs.sparkSession
    n_parts = n_parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    split, firsts = _parts(rows.filter("doc_id is not null").select("doc_id", F.col("doc_id").cast("double").alias("id")), n_parts)
    # (first id of a range, range before it): at most n_parts rows.
    ends = [(first, firsts[k - 1][0]) for k, (_, first) in enumerate(firsts)]
    before = spark.createDataFrame(ends, "first bigint, before int")
    placed = split.transform(rows.filter("doc_id is not null").withColumn("id", F.col("doc_id").cast("double")))
    placed = placed.select(F.col("part").cast("int").alias("part"), "doc_id", "text", F.xxhash64("text").alias("tie"))
    placed = placed.join(F.broadcast(before), placed["doc_id"] == before["first"], "left").drop("first")
    own = F.struct("part", F.lit(0).alias("end"))
    copy = F.struct(F.col("before").alias("part"), F.lit(1).alias("end"))
    placed = placed.select(F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, copy))).alias("at"), "doc_id", "tie", "text")
    placed = placed.select("at.part", "at.end", "doc_id", "tie", "text")
    alone = rows.filter("doc_id is null").select(F.lit(-1).alias("part"), F.lit(0).alias("end"), "doc_id", F.lit(0).cast("bigint").alias("tie"), "text")
    order = ["part", "end", "doc_id", "tie"]
    ordered = placed.repartition(n_parts, "part").sortWithinPartitions(*order)
    return _run(ordered).unionByName(_run(alone))


def _run(ordered: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {"row": None, "part": None}
        for batch in batches:
            group, size = [], 0
            for i in range(batch.num_rows):
                row = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(2)[i].as_py(), batch.column(4)[i].as_py())
                group.append(row)
                size += len(row[3])
                if size >= _TOGETHER:
                    yield _emit(_paired(group, state))
                    group, size = [], 0
            yield _emit(_paired(group, state))

    return ordered.mapInArrow(run, _EDITED)


def _paired(rows: list[tuple], state: dict) -> list[tuple[int | None, str, str]]:
    """(id, text, next text) of every row whose next row is known; the last row is held in ``state``."""
    out = []
    for part, end, doc_id, text in rows:
        if part < 0:
            out.append((None, text, ""))
            continue
        held = state["row"]
        if held is not None:  # a range ends with the first rows of the next one
            out.append((*held, text))
        state["row"] = None if end else (doc_id, text)
    return out


def _emit(pairs: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
    texts, edited = [], []
    for _, text, after in pairs:
        half = len(text) // 2
        texts.append(text.encode("utf-8", "surrogatepass"))
        edited.append((text[: len(text) - half] + after[:half]).encode("utf-8", "surrogatepass"))
    # A row's next text is as a rule the next row's own text: it is hashed once.
    own = sketch_all(texts)
    changed = sketch_all(edited)
    nexts, missing = [None] * len(pairs), []
    for k, (_, _, after) in enumerate(pairs):
        if k + 1 < len(pairs) and pairs[k + 1][1] == after:
            nexts[k] = own[k + 1]
        else:
            missing.append(k)
    for k, found in zip(missing, sketch_all([pairs[k][2].encode("utf-8", "surrogatepass") for k in missing]), strict=True):
        nexts[k] = found
    to_edited = [compare(a, b) for a, b in zip(own, changed, strict=True)]
    to_next = [compare(a, b) for a, b in zip(own, nexts, strict=True)]
    columns = [
        pa.array([p[0] for p in pairs], pa.int64()),
        pa.array([len(p[1]) for p in pairs], pa.int64()),
        pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
        pa.array([encode(s) for s in own], pa.string()),
        pa.array([encode(s) for s in changed], pa.string()),
        pa.array([c[0] for c in to_edited], pa.float64()),
        pa.array([c[0] for c in to_next], pa.float64()),
        pa.array([c[1] for c in to_edited], pa.float64()),
        pa.array([c[2] for c in to_next], pa.float64()),
    ]
    names = [x.split()[0] for x in _EDITED.split(", ")]
    return pa.RecordBatch.from_arrays(columns, names)

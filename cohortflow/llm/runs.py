"""Periodic runs of words in whole documents, found by internal pattern matching.

A run is a stretch of consecutive words with smallest period q that no neighbouring
word extends and that is at least ``max(12, 2 q)`` words long.  Words are
``[^\\x20\\x09-\\x0D]+``.

Method, for a few documents at a time (their words are told apart, so that no match
crosses two documents):

* prefix doubling gives the suffix array, and for every dyadic length 2^k the group of
  every position (equal words for 2^k words); groups are intervals of the suffix array;
* a run of period q holds an aligned dyadic block of length m, 2m - 1 <= q <= 4m - 2,
  whose content occurs again q words later; the blocks of 4 words stand at every second
  word and also serve the short periods;
* a wavelet matrix over the suffix array answers "next occurrence of this block at or
  after x" (range successor);
* occurrences closer than half a block form an arithmetic progression.  Inside the
  block's own run they are multiples of its period and give nothing; in another run they
  give the two distances that align the ends of both runs, or, where the runs touch,
  every term;
* every candidate distance is extended to both sides with the groups (longest common
  extension), which decides exactly.

Memory is bounded by ``GROUP`` words or by the longest document, whichever is more.

Rows keep their number: repeated rows and ids give a row each.  A null or empty text
has no word and no run; a null id gets no edit.  Columns other than the id and the
text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of documents that are searched together.
GROUP = 1 << 17
#: Shortest run.
LEAST_LENGTH = 12
#: Blocks of 2**BASE words at every second word serve all periods below 2**(BASE + 2) - 1.
BASE = 2


class Factors:
    """Suffix array of a sequence and, per dyadic length, the group of every position."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.n = n
        self.blocks: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        self.slots = np.zeros(0, dtype=np.int64)
        order = np.argsort(codes, kind="stable")
        slots, active = np.arange(n), order
        self.suffixes = order.copy()
        rank = np.full(n + 1, -1, dtype=np.int64)  # one more: past the end, equal to nothing
        key, length, k = codes[order], 1, 0
        self.levels: list[np.ndarray] = []
        while True:
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, dtype=np.int64)
            sizes = np.diff(np.append(first, len(key)))
            rank = rank.copy()
            rank[active] = np.repeat(slots[first], sizes)
            self.suffixes[slots] = active
            self.levels.append(rank)
            many = np.repeat(sizes > 1, sizes)
            size = np.repeat(sizes, sizes)[many]
            active, slots = active[many], slots[many]
            if k == BASE:
                self.slots = slots
            if k >= BASE and len(active):
                here = active % (2 if k == BASE else length) == 0
                self.blocks.append((length, active[here], rank[active[here]], size[here]))
            if not len(active):
                return
            key = rank[active] * (n + 1) + rank[np.minimum(active + length, n)] + 1
            by = np.argsort(key, kind="stable")
            active, key = active[by], key[by]
            length, k = 2 * length, k + 1

    def right(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the longest common extension to the right of x and y, x < y."""
        x, y = x.copy(), y.copy()
        start = x.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            same = (self.levels[k][x] == self.levels[k][y]).astype(np.int64) << k
            x += same
            y += same
        return x - start

    def left(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The same for the words before x and y."""
        x, y = x.copy(), y.copy()
        start = x.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            step = 1 << k
            fits = x >= step
            same = (fits & (self.levels[k][np.where(fits, x - step, self.n)] == self.levels[k][np.where(fits, y - step, 0)])).astype(np.int64) << k
            x -= same
            y -= same
        return start - x


class Wavelet:
    """Wavelet matrix over distinct positions, with range successor queries."""

    def __init__(self, values: np.ndarray):
        self.sorted = np.sort(values)
        self.bits = max(1, (len(values) - 1).bit_length())
        v = np.searchsorted(self.sorted, values)
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            one = (v >> bit) & 1
            self.zeros.append(np.concatenate(([0], np.cumsum(1 - one))))
            v = np.concatenate((v[one == 0], v[one == 1]))

    def successor(self, low: np.ndarray, high: np.ndarray, x: np.ndarray, none: int) -> np.ndarray:
        """Smallest value >= x of each interval [low, high), ``none`` where there is none."""
        at = np.searchsorted(self.sorted, x)
        below, a, b = np.zeros_like(low), low, high
        for z, bit in zip(self.zeros, range(self.bits - 1, -1, -1), strict=True):
            za, zb = z[a], z[b]
            one = (at >> bit) & 1 == 1
            below = below + np.where(one, zb - za, 0)
            a, b = np.where(one, a - za + z[-1], za), np.where(one, b - zb + z[-1], zb)
        below = np.where(at >= len(self.sorted), high - low, below)
        found = below < high - low
        a, b, wanted, value = low, high, np.where(found, below, 0), np.zeros_like(low)
        for z in self.zeros:
            za, zb = z[a], z[b]
            one = wanted >= zb - za
            value = 2 * value + one
            wanted = np.where(one, wanted - (zb - za), wanted)
            a, b = np.where(one, a - za + z[-1], za), np.where(one, b - zb + z[-1], zb)
        return np.where(found, self.sorted[np.where(found, value, 0)], none)


def _candidates(f: Factors, w: Wavelet, length: int, block: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block start, distance) pairs of one level's blocks: candidate periods."""
    base = length == 1 << BASE
    least, most = (1 if base else 2 * length - 1), 4 * length - 2
    none = 4 * f.n + 4 * length
    at = w.successor(low, high, block + least, none)
    while True:
        live = at <= block + most
        block, low, high, at = block[live], low[live], high[live], at[live]
        if not len(block):
            return
        yield block, at - block
        after = w.successor(low, high, at + 1, none)
        tight = np.flatnonzero(after - at <= length // 2)
        if len(tight):
            b, s = block[tight], at[tight]
            p = after[tight] - s
            own = b - f.left(b, b + p), b + p + f.right(b, b + p)
            other = s - f.left(s, s + p), s + p + f.right(s, s + p)
            apart = own[0] != other[0]
            for q in (other[0] - own[0], other[1] - own[1]):
                fits = apart & (q >= least) & (q <= most)
                yield b[fits], q[fits]
            touch = np.flatnonzero(apart & (own[1] >= other[0]))
            last = np.minimum(b + most, other[1] - length)[touch]
            terms = np.maximum((last - s[touch]) // p[touch] + 1, 0)
            step = np.arange(terms.sum()) - np.repeat(np.cumsum(terms) - terms, terms)
            yield np.repeat(b[touch], terms), np.repeat((s - b)[touch], terms) + step * np.repeat(p[touch], terms)
            after[tight] = w.successor(low[tight], high[tight], np.maximum(other[1] - length, s) + 1, none)
        at = after


def find_runs(codes: np.ndarray, least: int = LEAST_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of every run of a sequence, by start, then period."""
    f = Factors(codes)
    nothing = np.zeros(0, dtype=np.int64)
    if not f.blocks:
        return nothing, nothing, nothing
    w = Wavelet(f.suffixes[f.slots])
    at, by = [], []
    for length, block, slot, size in f.blocks:
        low = np.searchsorted(f.slots, slot)
        for b, q in _candidates(f, w, length, block, low, low + size):
            at.append(b)
            by.append(q)
    if not at:
        return nothing, nothing, nothing
    pair = np.unique(np.concatenate(at) * (4 * f.n + 4) + np.concatenate(by))
    b, q = pair // (4 * f.n + 4), pair % (4 * f.n + 4)
    b, q = b[b + q < f.n], q[b + q < f.n]  # an aligned distance need not be an occurrence
    start, end = b - f.left(b, b + q), b + q + f.right(b, b + q)
    long = end - start >= np.maximum(least, 2 * q)
    start, end, q = start[long], end[long], q[long]
    # Of one stretch the smallest period counts; the others are its multiples.
    by_stretch = np.lexsort((q, end, start))
    start, end, q = start[by_stretch], end[by_stretch], q[by_stretch]
    fresh = np.concatenate(([True], (start[1:] != start[:-1]) | (end[1:] != end[:-1]))) if len(q) else np.zeros(0, dtype=bool)
    start, end, q = start[fresh], end[fresh], q[fresh]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's edit: the tail of one document in ten becomes periodic."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[: n - a]


def word_runs(documents: list[list[bytes]], least: int = LEAST_LENGTH) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of every document, by start, then period."""
    lengths = np.array([len(words) for words in documents], dtype=np.int64)
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    known: dict[bytes, int] = {}
    number = known.setdefault
    codes = np.fromiter((number(x, len(known)) for words in documents for x in words), dtype=np.int64, count=int(bounds[-1]))
    # Words of different documents never match.
    start, end, period = find_runs(np.repeat(np.arange(len(documents)), lengths) * max(1, len(known)) + codes, least)
    owner = np.searchsorted(bounds, start, side="right") - 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    for d, s, e, q in zip(owner.tolist(), (start - bounds[owner]).tolist(), (end - bounds[owner]).tolist(), period.tolist(), strict=True):
        out[d].append((s, e - s, q))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside runs and those of every run's first period that no other run drops."""
    if not runs:
        return words
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]


def _grouped(batches: Iterator[pa.RecordBatch], edit) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and words of a few documents at a time."""
    ids, documents, total = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column(0), batch.column(1), strict=True):
            i, text = i.as_py(), text.as_py()
            words = edit(i, text.encode("utf-8", "surrogatepass").split() if text else [])
            if documents and total + len(words) > GROUP:
                yield ids, documents
                ids, documents, total = [], [], 0
            ids.append(i)
            documents.append(words)
            total += len(words)
    if documents:
        yield ids, documents


_ROW = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: all runs by start, then period,
    and the text without the repeats, its words joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for ids, documents in _grouped(batches, lambda _, words: words):
            found = word_runs(documents, least)
            runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in one] for one in found]
            text = [b" ".join(collapse(words, one)).decode("utf-8", "surrogatepass") for words, one in zip(documents, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(x) for x in documents], pa.int64()), pa.array(runs, kind), pa.array(text, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return _columns(docs, id_col, text_col).mapInArrow(run, _ROW)


_DIGEST = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edit=repeat_tail) -> DataFrame:
    """One row per document: number of runs, the longest one, digests of all runs and of
    the collapsed text.  ``edit(doc_id, words)`` changes the words before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, documents in _grouped(batches, edit):
            rows = []
            for i, words, runs in zip(ids, documents, word_runs(documents), strict=True):
                best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
                lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                rows.append(
                    (i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(collapse(words, runs))).hexdigest())
                )
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return _columns(docs, id_col, text_col).mapInArrow(run, _DIGEST)


def _columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

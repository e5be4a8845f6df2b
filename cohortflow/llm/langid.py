"""Language identification by prediction by partial matching.

Every language gets a byte context tree of order ``ORDER`` over a common
alphabet (the most frequent bytes of the training sample; any other byte is
coded by one more symbol and then uniformly, at the same cost in every
language).  A byte is coded in its longest seen context; a byte that the context
has not seen is coded by an escape to the context one byte shorter, down to a
uniform code (escape method C: distinct successors against total count).  The
statistics are frozen after training, so every context's code lengths are fixed
numbers and a text's exact code length is a sum that any batch order gives.

A context tree is used as an automaton: its states are the seen contexts, and
one step looks up the code length of a byte in every language and the longest
seen context after it.  Texts are cut into segments that start ``ORDER`` bytes
early, which brings each segment into exactly the state the whole text would be
in, so many segments advance side by side in numpy.

Training: at most ``SAMPLE_BYTES`` bytes per language of labelled documents
outside the held-out fold, each distinct text once, in hash order; long documents in pieces.  Texts are folded to lower case first.

Defined results: null texts and texts without a letter are ``und`` with score
0; ties go to the first language in code point order; without training rows
every text is ``und``; repeated rows are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ORDER = 3
SAMPLE_BYTES = 600_000
ALPHABET = 48  # coded symbols, the symbol for all other bytes included
_SEGMENT = 512
_LETTER = regex.compile(r"\p{L}")


def held_out(id_col: str):
    """The fold that no language is learned from."""
    return F.crc32(F.col(id_col).cast("string")) % 4 == 2


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(lang, text) of at most ``sample_bytes`` bytes per language, in hash order.

    Whole documents are taken while their running size stays in the bound, each
    distinct text once; a document above a quarter of it is taken in pieces, each a row
    of its own.  A row's order key is found in buckets first, so no language is sorted whole.
    """
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.coalesce(~held_out(id_col), F.lit(True)))
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    # A character has at most four bytes, so a piece has at most a quarter of the bound.
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{max(sample_bytes // 16, 1)}}}"), F.lit(0))
    long = F.octet_length("text") > sample_bytes // 4
    rows = rows.select("lang", F.explode(F.when(long, pieces).otherwise(F.array("text"))).alias("text"))
    rows = rows.select("lang", "text", F.octet_length("text").cast("bigint").alias("size"), F.xxhash64(F.lit(17), "text").alias("key")).filter("size > 0")
    # Bucket b holds a 2**-b share of the hashes: buckets from the rarest on, until the bound is met.
    bucket = F.least(F.lit(30), F.length(F.regexp_extract(F.lpad(F.bin(F.shiftrightunsigned("key", 34)), 30, "0"), "^0*", 0)))
    rows = rows.withColumn("bucket", bucket)
    sizes = rows.select("lang", "bucket", "key", "size").distinct().groupBy("lang", "bucket").agg(F.sum("size").alias("bytes"))
    after = Window.partitionBy("lang").orderBy(F.desc("bucket"))
    start = sizes.withColumn("before", F.sum("bytes").over(after) - F.col("bytes")).filter(F.col("before") < sample_bytes).select(F.col("lang").alias("l"), F.col("bucket").alias("b"))
    near = rows.join(F.broadcast(start), (F.col("lang") == F.col("l")) & (F.col("bucket") == F.col("b"))).drop("l", "b").dropDuplicates(["lang", "key"])
    order = Window.partitionBy("lang").orderBy(F.desc("bucket"), "key", "text")
    run = near.select("lang", "text", "size", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    return run.filter(F.col("run") <= sample_bytes).select("lang", "text")


class ContextTrees:
    """The trees of all languages as one automaton."""

    def __init__(self, languages: list[str], symbol: np.ndarray, cost: np.ndarray, step: np.ndarray, other_bits: float):
        self.languages, self.symbol, self.cost, self.step, self.other_bits = languages, symbol, cost, step, other_bits

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Exact code length in bits of every text in every language."""
        out = np.zeros((len(texts), len(self.languages)))
        rows, owner = [], []
        other = self.symbol.max()
        for i, t in enumerate(texts):
            s = self.symbol[np.frombuffer(t, dtype=np.uint8)]
            out[i] += self.other_bits * np.count_nonzero(s == other)
            for at in range(0, len(s), _SEGMENT):
                lead = min(at, ORDER)
                rows.append((s, at - lead, lead, min(at + _SEGMENT, len(s))))
                owner.append(i)
        order = sorted(range(len(rows)), key=lambda r: rows[r][1] - rows[r][3])
        for part in range(0, len(order), 4096):
            self._advance([rows[r] for r in order[part : part + 4096]], np.array([owner[r] for r in order[part : part + 4096]]), out)
        return out

    def _advance(self, rows: list, owner: np.ndarray, out: np.ndarray) -> None:
        """Advance segments (longest first) side by side and add their code lengths."""
        lengths = np.array([end - at for _, at, _, end in rows])
        leads = np.array([lead for _, _, lead, _ in rows])
        grid = np.zeros((lengths[0], len(rows)), dtype=np.int64)
        for r, (s, at, _, end) in enumerate(rows):
            grid[: end - at, r] = s[at:end]
        state = np.zeros(len(rows), dtype=np.int64)
        total = np.zeros((len(rows), len(self.languages)))
        width = self.step.shape[1]
        step, cost = self.step.reshape(-1), self.cost.reshape(-1, self.cost.shape[2])
        alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # segments longer than t
        for t in range(lengths[0]):
            n = alive[t]
            at = state[:n] * width + grid[t, :n]
            bits = cost[at]
            if t < ORDER:
                bits = bits * (leads[:n] <= t)[:, None]  # bytes before the segment only set its state
            total[:n] += bits
            state[:n] = step[at]
        np.add.at(out, owner, total)


def build_trees(sample: dict[str, list[bytes]], order: int = ORDER, alphabet: int = ALPHABET) -> ContextTrees:
    """Count contexts per language and freeze their code lengths."""
    languages = sorted(sample)
    counts = np.zeros(256, dtype=np.int64)
    for texts in sample.values():
        for t in texts:
            counts += np.bincount(np.frombuffer(t, dtype=np.uint8), minlength=256)
    common = sorted(np.argsort(-counts, kind="stable")[: alphabet - 1].tolist())
    symbol = np.full(256, alphabet - 1, dtype=np.int64)
    symbol[common] = np.arange(len(common))
    other_bits = float(np.log2(256 - len(common)))
    n_lang = len(languages)
    # grams[k]: code of (context of k symbols, next symbol) -> counts per language.
    grams: list[dict[str, np.ndarray]] = []
    for k in range(order + 1):
        codes, which = [], []
        for g, lang in enumerate(languages):
            for t in sample[lang]:
                s = symbol[np.frombuffer(t, dtype=np.uint8)]
                if len(s) > k:
                    c = np.zeros(len(s) - k, dtype=np.int64)
                    for j in range(k + 1):
                        c = c * alphabet + s[j : len(s) - k + j]
                    codes.append(c)
                    which.append(np.full(len(c), g, dtype=np.int64))
        c = np.concatenate(codes) if codes else np.zeros(0, dtype=np.int64)
        w = np.concatenate(which) if which else np.zeros(0, dtype=np.int64)
        seen, n = np.unique(c * n_lang + w, return_counts=True)
        keys, back = np.unique(seen // n_lang, return_inverse=True)
        table = np.zeros((len(keys), n_lang), dtype=np.int64)
        table[back, seen % n_lang] = n
        grams.append({"keys": keys, "counts": table})
    # States: contexts of length 0..order seen in any language; state 0 is empty.
    contexts = [np.zeros(1, dtype=np.int64)] + [np.unique(grams[k]["keys"] // alphabet) for k in range(1, order + 1)]
    first = np.concatenate(([0], np.cumsum([len(c) for c in contexts])))
    n_states = int(first[-1])
    cost = np.zeros((n_states, alphabet, n_lang), dtype=np.float64)
    step = np.zeros((n_states, alphabet), dtype=np.int64)
    uniform = np.full((1, alphabet, n_lang), np.log2(alphabet))
    for k in range(order + 1):
        keys, table = grams[k]["keys"], grams[k]["counts"]
        own = contexts[k]
        here = np.zeros((len(own), alphabet, n_lang), dtype=np.int64)
        if k == 0:
            here[0, keys] = table
            shorter = uniform
        else:
            here[np.searchsorted(own, keys // alphabet), keys % alphabet] = table
            suffix = own % alphabet ** (k - 1) if k > 1 else np.zeros(len(own), dtype=np.int64)
            shorter = cost[first[k - 1] + np.searchsorted(contexts[k - 1], suffix)]
        total = here.sum(axis=1, keepdims=True)
        distinct = (here > 0).sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            seen_bits = np.log2((total + distinct) / here)
            escape = np.where(total > 0, np.log2((total + distinct) / np.maximum(distinct, 1)), 0.0)
        cost[first[k] : first[k + 1]] = np.where(here > 0, seen_bits, escape + shorter)
        # The state after (context, symbol): the longest seen suffix of the two.
        after = own[:, None] * alphabet + np.arange(alphabet)[None, :]
        length = min(k + 1, order)
        after = after % alphabet**length
        target = np.zeros(after.shape, dtype=np.int64)
        open_ = np.ones(after.shape, dtype=bool)
        for j in range(length, 0, -1):
            tail = after % alphabet**j
            place = np.minimum(np.searchsorted(contexts[j], tail), max(len(contexts[j]) - 1, 0))
            hit = open_ & (len(contexts[j]) > 0) & (contexts[j][place] == tail) if len(contexts[j]) else np.zeros_like(open_)
            target[hit] = first[j] + place[hit]
            open_ &= ~hit
        step[first[k] : first[k + 1]] = target
    return ContextTrees(languages, symbol, cost.astype(np.float32), step.astype(np.int32), other_bits)


def train(sample: DataFrame) -> ContextTrees:
    """Trees from a sample of bounded size (one row per document)."""
    texts: dict[str, list[bytes]] = {}
    for row in sample.orderBy("lang", "text").toLocalIterator():
        texts.setdefault(row["lang"], []).append(row["text"].lower().encode("utf-8", "surrogatepass"))
    return build_trees(texts)


def identify(docs: DataFrame, trees: ContextTrees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row: the shortest code wins.

    ``score`` is the winner's posterior under equal priors at one bit per
    byte-length unit: differences of code length per letter, softened.
    """
    model = docs.sparkSession.sparkContext.broadcast(trees)  # bounded by SAMPLE_BYTES per language

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for pdf in batches:
            at, ids, texts = 0, pdf["i"].tolist(), pdf["t"].tolist()
            while at < len(texts):
                end, load = at, 0
                while end < len(texts) and (end == at or load < 4_000_000):
                    load += len(texts[end] or "")
                    end += 1
                part = [t if t and m.languages and _LETTER.search(t) else None for t in texts[at:end]]
                coded = [t.lower().encode("utf-8", "surrogatepass") if t else b"" for t in part]
                preds, scores = ["und"] * len(part), [0.0] * len(part)
                if m.languages:
                    bits = m.code_lengths(coded)
                    for k, t in enumerate(part):
                        if t:
                            # Bits per byte, sharpened: a tenth of a bit a byte is a clear lead.
                            gap = (bits[k] - bits[k].min()) * np.log(2.0) * min(1.0, 64.0 / len(coded[k]))
                            best = int(np.argmin(bits[k]))
                            preds[k], scores[k] = m.languages[best], float(1.0 / np.exp(-gap).sum())
                yield pd.DataFrame({"doc_id": ids[at:end], "lang_pred": preds, "score": scores})
                at = end

    out = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).mapInPandas(run, "doc_id string, lang_pred string, score double")
    return out.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def predict_languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    found = identify(docs, train(training_sample(docs)))
    return found.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "lang_pred", "score")

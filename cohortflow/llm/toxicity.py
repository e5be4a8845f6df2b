"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

1. Folding: lower case, homoglyphs to Latin letters, hidden marks removed; a second
   reading also drops accents and undoes digit and sign substitutions inside
   words (``l0s3r``).  One character folds to one character or to none.
2. One Aho-Corasick automaton holds words, word stems and exception phrases
   (``clown fish``).  A word counts between word boundaries, a stem at the start
   of a word, and neither inside an exception phrase.
3. Learned from labelled documents: each term's log ratio of its rates in toxic
   and clean texts, and the stems themselves: word beginnings that toxic documents without any
   seed word use far more often than clean ones do (other languages' abuse).
4. A document's matches become their weight, repeats included, and that weight
   over the text's length; a logistic curve over both, fitted on the same
   documents, gives the score.

Learning reads at most ``SAMPLE`` labelled documents outside the held-out fold.

Defined results: null and empty texts score the curve's value at no match;
repeated rows are scored one by one; without labels of both classes the seed
words have equal weights and a fixed curve.
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.session import materialize

#: Labelled documents learned from, at most.
SAMPLE = 8000
#: Learned stems, at most, and the evidence (G-squared), log ratio and length a stem needs.
STEMS, STEM_EVIDENCE, STEM_RATIO, STEM_LENGTHS = 60, 25.0, 2.3, range(3, 11)
# Common insults and abuse (seed terms), and phrases in which they are harmless.
SEED_TERMS = (
    "idiot idiots moron morons stupid imbecile dumbass trash scum loser losers clown pathetic worthless disgusting filth filthy "
    "vermin parasite subhuman degenerate retard retarded bastard bitch whore slut asshole shit fuck fucking crap jerk freak creep "
    "pig swine rat garbage hate hateful kys dimwit halfwit nitwit lowlife coward ugly repulsive despicable "
    "dummkopf arschloch abschaum schwein connard salaud ordure imbécile idiota basura escoria estúpido cabrón"
).split()
EXCEPTIONS = (
    "clown fish", "clown car", "class clown", "trash can", "trash bin", "trash collection", "recycle trash", "garbage collection", "garbage collector", "garbage can",
    "guinea pig", "pig iron", "pig farm", "lab rat", "rat race", "sore loser", "stupid simple", "not stupid", "not an idiot", "idiot proof", "pond scum", "soap scum",
    "hate crime", "hate speech", "freak accident",
)
_GLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "α": "a", "ο": "o", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ɡ": "g", "ı": "i", "ł": "l", "ø": "o", "ß": "s",
}
_DIGITS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "$": "s", "@": "a", "!": "i", "|": "l", "+": "t"})
_EDGE = ".,;:!?\"'()[]*#$%&|"
_HIDDEN = "​‌‍⁠﻿­"


class _Fold(dict):
    """Character table filled on first use: lower case, homoglyphs to Latin, hidden marks off."""

    def __init__(self, accents: bool):
        super().__init__()
        self.accents = accents

    def __missing__(self, code: int):
        ch = chr(code)
        low = ch.lower()
        if ch in _HIDDEN or (unicodedata.combining(ch) and not self.accents):
            out = ""
        else:
            base = _GLYPHS.get(low) or unicodedata.normalize("NFKC" if self.accents else "NFKD", low)
            if not self.accents:
                base = "".join(c for c in base if not unicodedata.combining(c))
            base = "".join(_GLYPHS.get(c, c) for c in base.lower())
            out = base if len(base) == 1 else (low if len(low) == 1 else ch)
        self[code] = out
        return out


_LIGHT, _DEEP = _Fold(True), _Fold(False)


def fold(text: str) -> str:
    """Lower case, homoglyphs to Latin, hidden marks off; accents and digits stay."""
    return text.translate(_LIGHT)


def unmask(text: str) -> tuple[str, str]:
    """The text without accents, and that with digit and sign substitutions undone."""
    deep = text.translate(_DEEP)
    return deep, deep.translate(_DIGITS)


@dataclass
class Lexicon:
    """Term weights, exception phrases and the fitted curve."""

    words: dict[str, float]
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (0.8, 0.2, -3.0)  # of weight, density, and the intercept

    def automaton(self):
        a = ahocorasick.Automaton()
        kinds: dict[str, list] = {}
        for term, w in self.words.items():
            kinds.setdefault(fold(term), []).append(("word", w, term))
            kinds.setdefault(unmask(term)[0], []).append(("plain", w, term))
        for term, w in self.stems.items():
            kinds.setdefault(term, []).append(("stem", w, term))
        for phrase in self.exceptions:
            kinds.setdefault(fold(phrase), []).append(("exception", 0.0, phrase))
        for key, uses in kinds.items():
            a.add_word(key, (len(key), uses))
        if len(a):
            a.make_automaton()
        return a


def matches(automaton, text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, term, weight) of the counted matches, spans in the folded text."""
    if not text or not len(automaton):
        return []
    light = fold(text)
    found = _find(automaton, light, light, ("word", "stem"))
    deep, masked = unmask(text)
    if masked != light:
        plain = Counter(m[2] for m in found)
        for m in _find(automaton, masked, deep, ("plain",)):
            if deep[m[0] : m[1]] == masked[m[0] : m[1]] and plain[m[2]]:
                plain[m[2]] -= 1  # found as it stands already; disguised repeats count
            elif any(c.isalpha() for c in deep[m[0] : m[1]]):  # digits and signs alone are a number
                found.append(m)
    return found


def _find(automaton, text: str, original: str, kinds: tuple) -> list[tuple[int, int, str, float]]:
    hits, shielded = [], []
    n = len(text)
    for end, (length, uses) in automaton.iter(text):
        start = end - length + 1
        # Boundaries are judged before substitutions are undone: "!!" ends a word.
        if start and original[start - 1].isalnum():
            continue
        whole = end + 1 >= n or not original[end + 1].isalnum()
        for kind, weight, term in uses:
            if kind == "exception":
                if whole:
                    shielded.append((start, end + 1))
            elif kind in kinds and (whole or kind == "stem"):
                hits.append((start, end + 1, term, weight))
    if shielded and hits:
        shielded.sort()
        starts, reach = [s for s, _ in shielded], list(accumulate((e for _, e in shielded), max))
        # A hit is shielded if a phrase that starts at or before it reaches its end.
        hits = [h for h in hits if not (k := bisect_right(starts, h[0])) or reach[k - 1] < h[1]]
    return hits


def features(found: list[tuple[int, int, str, float]], n_words: int) -> tuple[float, float]:
    """(weight, density): summed weights, repeats of a term damped, and weight per 100 words."""
    by_term: dict[str, list] = {}
    for _, _, term, w in found:
        by_term.setdefault(term, []).append(w)
    weight = sum(ws[0] * (1.0 + math.log(len(ws))) for ws in by_term.values())
    density = 100.0 * sum(sum(ws) for ws in by_term.values()) / max(n_words, 20)
    return round(min(weight, 60.0), 6), round(min(density, 60.0), 6)


def held_out(id_col: str):
    """The fold that no label is learned from."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text, label) of at most ``sample`` labelled documents, in hash order."""
    lab = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    lab = lab.filter(~held_out("doc_id")).orderBy(F.xxhash64(F.lit(23), "doc_id"), "doc_id").limit(sample)
    return docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("text")).join(F.broadcast(lab), F.col("d") == lab["doc_id"]).select("doc_id", "text", "label")  # a bounded side


def _words(text: str) -> list[str]:
    return [w.strip(_EDGE) for w in fold(text).split()]


def _count(sample: DataFrame, seeds: list[str], stems: frozenset | None) -> DataFrame:
    """(term, orphan, toxic, clean, orphan_docs): occurrences by kind of document.

    Orphans are toxic documents without a seed word.  Without ``stems``: word
    beginnings of the orphans.  With them: seed words and the given beginnings
    in all documents.  The term "" counts words.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = Lexicon(dict.fromkeys(seeds, 1.0)).automaton()
        for pdf in batches:
            out: dict[str, list[int]] = {}
            for text, label in zip(pdf["text"], pdf["label"], strict=True):
                hits = [m[2] for m in matches(a, text)] if text else []
                kind = 2 if not int(label) else (1 if hits else 0)
                if stems is None and kind:
                    continue
                seen: dict[str, int] = {}
                words = _words(text or "")
                for w in words:
                    for k in STEM_LENGTHS:
                        if k > len(w):
                            break
                        if stems is None or w[:k] in stems:
                            seen[w[:k]] = seen.get(w[:k], 0) + 1
                if stems is not None:
                    for t in hits:
                        seen["=" + t] = seen.get("=" + t, 0) + 1
                    seen[""] = len(words)
                for t, n in seen.items():
                    c = out.setdefault(t, [0, 0, 0, 0])
                    c[kind] += min(n, 10) if t else n
                    c[3] += kind == 0
            yield pd.DataFrame([(t, *c) for t, c in out.items()], columns=["term", "o", "t", "c", "d"])

    counts = sample.mapInPandas(run, "term string, o bigint, t bigint, c bigint, d bigint")
    return counts.groupBy("term").agg(*[F.sum(x).alias(y) for x, y in (("o", "orphan"), ("t", "toxic"), ("c", "clean"), ("d", "orphan_docs"))])


def _log_ratio(a: float, n_a: float, b: float, n_b: float) -> float:
    return math.log((a + 0.5) / (n_a + 1.0)) - math.log((b + 0.5) / (n_b + 1.0))


def _evidence(a: float, n_a: float, b: float, n_b: float) -> float:
    """G-squared of rate a/n_a above rate b/n_b (0 where it is not above)."""
    pooled = (a + b) / max(n_a + n_b, 1.0)
    if n_a <= 0 or a / n_a <= pooled:
        return 0.0
    return 2.0 * (a * math.log(a / (n_a * pooled)) + (b * math.log(b / (n_b * pooled)) if b else 0.0))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Lexicon:
    """The lexicon, its weights and the curve, from labelled documents."""
    rows = materialize(labelled_sample(docs, labels, id_col, text_col, sample))
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals.get(1) or not totals.get(0):
        return Lexicon(dict.fromkeys(SEED_TERMS, 5.0))
    seeds = list(SEED_TERMS)
    distinct = rows.dropDuplicates(["text"])  # exact copies say nothing new
    begun = _count(distinct, seeds, None).filter(f"orphan_docs >= {max(3, totals[1] // 100)} and orphan >= 5")
    # A bounded list: the most widespread beginnings of the orphans.
    begun = [r["term"] for r in begun.orderBy(F.desc("orphan_docs"), F.desc("orphan"), "term").limit(20_000).collect()]
    counts = {r["term"]: r for r in _count(distinct, seeds, frozenset(begun)).collect()}
    total = counts.get("")
    n_o, n_t, n_c = (float(total[k] or 0) if total else 0.0 for k in ("orphan", "toxic", "clean"))
    words = {}
    for t in seeds:
        r = counts.get("=" + t)
        if r is not None:
            words[t] = _log_ratio(r["toxic"], n_t, r["clean"], n_c)
    usual = float(np.median(sorted(words.values()))) if words else 5.0
    for t in seeds:
        words.setdefault(t, usual)  # not in the sample
    ranked = sorted(
        ((_evidence(r["orphan"], n_o, r["clean"], n_c), len(t), t, _log_ratio(r["orphan"], n_o, r["clean"], n_c)) for t, r in counts.items() if t and t[0] != "="),
        key=lambda x: (-round(x[0], 6), -x[1], x[2]),
    )
    stems: dict[str, float] = {}
    for evidence, _, t, w in ranked:
        if evidence < STEM_EVIDENCE or len(stems) >= STEMS:
            break
        if w > STEM_RATIO and not any(t.startswith(q) or q.startswith(t) for q in stems):
            stems[t] = w
    lex = Lexicon({t: w for t, w in words.items() if w > 0.5}, stems)
    # One row per labelled document of the bounded sample.
    seen = score_rows(rows, lex, "text", "label").select("weight", "density", "label").collect()
    lex.curve = _fit_curve(np.array([[r["weight"], r["density"], 1.0] for r in seen]), np.array([float(r["label"]) for r in seen]))
    return lex


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic coefficients by Newton steps with halving, under a ridge; slopes not negative."""
    order = np.lexsort((y, x[:, 1], x[:, 0]))  # the same sums on every run
    x, y = x[order] / np.array([10.0, 10.0, 1.0]), y[order]
    ridge = np.array([0.05, 0.05, 0.001])

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float((np.logaddexp(0.0, z) - y * z).sum() + 0.5 * (ridge * b * b).sum())

    beta = np.array([1.0, 1.0, -3.0])
    for _ in range(200):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -35, 35)))
        g = x.T @ (p - y) + ridge * beta
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step, t, now = np.linalg.solve(h, g), 1.0, loss(beta)
        while t > 1e-6:
            trial = beta - t * step
            trial[:2] = np.maximum(trial[:2], 0.01)
            if loss(trial) < now:
                break
            t /= 2
        else:
            break
        beta = trial
    return round(float(beta[0] / 10), 9), round(float(beta[1] / 10), 9), round(float(beta[2]), 9)


def score_rows(docs: DataFrame, lex: Lexicon, text_col: str, carry: str) -> DataFrame:
    """(carry, weight, density, terms) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = lex.automaton()
        for pdf in batches:
            weights, densities, terms = [], [], []
            for text in pdf["t"]:
                found = matches(a, text) if text else []
                w, d = features(found, len(text.split())) if found else (0.0, 0.0)
                weights.append(w)
                densities.append(d)
                terms.append(sorted({f[2] for f in found}))
            yield pd.DataFrame({"c": pdf["c"], "weight": weights, "density": densities, "terms": terms})

    # Ids and labels travel as strings: pandas has no plain nullable long.
    slim = docs.select(F.col(carry).cast("string").alias("c"), F.col(text_col).cast("string").alias("t"))
    out = slim.mapInPandas(run, "c string, weight double, density double, terms array<string>")
    return out.select(F.col("c").cast("bigint").alias(carry), "weight", "density", "terms")


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, terms) of every row."""
    lex = learn(docs, labels, id_col, text_col)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = score_rows(slim, lex, "text", "doc_id")
    a, b, c = lex.curve
    p = 1 / (1 + F.exp(-(F.col("weight") * F.lit(a) + F.col("density") * F.lit(b) + F.lit(c))))
    return out.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), p.alias("score"), (p >= 0.5).cast("int").alias("predicted"), "terms")

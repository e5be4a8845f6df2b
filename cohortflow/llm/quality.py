"""Hierarchical empirical Bayes quality classifier.

1. Evidence: a logistic model over text statistics (shares of symbols, capitals,
   cell bars and shouting, repeated words, word lengths), fitted on a bounded
   sample of labelled documents (``SAMPLE`` rows), gives each document a log
   likelihood ratio of good against bad.
2. Sites: every document adds its expected goodness to its host and its path
   (grouped aggregation, partial before each shuffle).  A host's rate is shrunk toward
   the global rate, a path's rate toward its host's, with prior strengths set
   from the spread between sites (method of moments): sparse sites stay near
   their parent.
3. A document's posterior combines its evidence with its path's rate.

Here the host is the document's ``source`` and the path its ``lang`` below it;
any columns can be named.

Defined results: null and empty texts have the statistics of an empty text;
null host or path is a site of its own; repeated rows are scored one by one;
without labels of both classes every document scores 0.5 and is kept.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.session import materialize

#: Labelled documents the evidence model is fitted on, at most.
SAMPLE = 20_000
#: Each statistic enters as indicators of these levels, so that the evidence is a step function.
LEVELS = {
    "symbols": (0.005, 0.02, 0.06, 0.12),
    "capitals": (0.04, 0.08, 0.2, 0.5),
    "bars": (0.02, 0.1, 0.3),
    "shouts": (0.02, 0.1, 0.4),
    "repeats": (0.02, 0.05, 0.15, 0.4),
    "distinct": (0.1, 0.25, 0.4, 0.6),
    "word_length": (3.0, 4.0, 5.5, 7.0, 10.0),
    "n_words": (1, 5, 20, 60, 200, 1000),
    "digits": (0.02, 0.1, 0.3),
}
_ROUND = 6


def with_evidence_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with its statistics as ``q_<name>``.

    The words are split once; characters are counted by what is left after
    removing all others, which scans a text in long runs.
    """
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    split = docs.withColumn("q_words", F.filter(F.split(t, r"\s+"), lambda w: w != ""))
    w = F.col("q_words")
    words = F.size(w).cast("double")
    n = F.greatest(words, F.lit(1.0))
    length = F.length(t)
    chars = F.greatest(length, F.lit(1)).cast("double")
    only = lambda kept: F.length(F.regexp_replace(t, f"[^{kept}]+", "")) / chars
    times = lambda part: (length - F.length(F.replace(t, F.lit(part), F.lit("")))) / F.lit(len(part)) / n
    found = {
        "symbols": only(r"#$%&*@^~{}\\<>=+_"),
        "capitals": only("A-ZÀ-Þ"),
        "bars": times("|"),
        "shouts": times("!!"),
        "repeats": F.size(F.filter(w, lambda x, i: F.coalesce(x == F.get(w, i - 1), F.lit(False)))) / n,
        "distinct": F.size(F.array_distinct(w)) / n,
        "word_length": chars / n,
        "n_words": words,
        "digits": only("0-9"),
    }
    return split.select(*docs.columns, *[F.round(v, _ROUND).alias(f"q_{k}") for k, v in found.items()])


def _indicators() -> list:
    return [(F.col(f"q_{k}") >= F.lit(float(x))).cast("double").alias(f"i_{k}_{j}") for k, xs in LEVELS.items() for j, x in enumerate(xs)]


def _vector(df: DataFrame) -> DataFrame:
    names = [f"i_{k}_{j}" for k, xs in LEVELS.items() for j in range(len(xs))]
    return VectorAssembler(inputCols=names, outputCol="features").transform(df.select("*", *_indicators())).drop(*names)


class Evidence:
    """The fitted evidence model; ``llr`` is null-free and finite."""

    def __init__(self, model: LogisticRegressionModel | None, rate: float):
        self.model, self.rate = model, rate

    def score(self, features: DataFrame) -> DataFrame:
        """``features`` with ``llr``: log odds of good, less the fitted base rate."""
        if self.model is None:
            return features.withColumn("llr", F.lit(0.0))
        keep = features.columns
        out = self.model.transform(_vector(features))
        raw = vector_to_array("rawPrediction")[1]
        return out.withColumn("llr", F.round(raw - F.log(F.lit(self.rate / (1 - self.rate))), _ROUND)).select(*keep, "llr")


def fit_evidence(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Evidence:
    """Fit on at most ``sample`` labelled documents outside the held-out fold."""
    lab = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))
    lab = lab.filter(~held_out("doc_id")).orderBy(F.xxhash64(F.lit(3), "doc_id"), "doc_id").limit(sample)
    # At most ``sample`` narrow rows: a bounded side.
    rows = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("text")).join(F.broadcast(lab), F.col("d") == lab["doc_id"]).select("doc_id", "text", "label")
    f = materialize(with_evidence_features(rows).drop("text"))
    counts = {r["label"]: r["n"] for r in f.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Evidence(None, 0.5)
    model = LogisticRegression(maxIter=60, regParam=1e-3, featuresCol="features", labelCol="label").fit(_vector(f).select("features", "label"))
    return Evidence(model, counts.get(1.0, 0) / sum(counts.values()))


def held_out(id_col: str):
    """The fold that no model is fitted on."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def _strength(rates, n, mean, sites):
    """Prior strength from the spread between sites, by the method of moments.

    With between-site variance v, a Beta prior of mean m has strength m(1-m)/v - 1; kept
    within [2, 1e4] for a handful of sites or no spread at all.
    """
    spread = F.greatest(F.var_pop(rates) - mean * (1 - mean) / F.greatest(F.avg(n), F.lit(1.0)), F.lit(1e-6))
    return F.when(sites < 3, F.lit(50.0)).otherwise(F.least(F.greatest(mean * (1 - mean) / spread - 1, F.lit(2.0)), F.lit(1e4)))


def site_rates(scored: DataFrame, rate: float) -> DataFrame:
    """(host, path, path_rate) from rows (host, path, llr).

    One row per path: soft counts of good documents, shrunk path -> host -> global.
    """
    p = 1 / (1 + F.exp(-(F.col("llr") + F.log(F.lit(rate / (1 - rate))))))
    paths = materialize(scored.groupBy("host", "path").agg(F.sum(F.round(p, _ROUND).cast("decimal(20,6)")).cast("double").alias("good"), F.count(F.lit(1)).cast("double").alias("n")))
    hosts = materialize(paths.groupBy("host").agg(F.sum("good").alias("h_good"), F.sum("n").alias("h_n")))
    average = hosts.agg(F.sum("h_good") / F.sum("h_n")).first()[0]
    mean = min(max(float(average), 1e-3), 1 - 1e-3) if average is not None else 0.5
    k_host = hosts.agg(_strength(F.col("h_good") / F.col("h_n"), F.col("h_n"), F.lit(mean), F.count(F.lit(1))).alias("k")).first()["k"] or 50.0
    host_rate = (F.col("h_good") + F.lit(k_host * mean)) / (F.col("h_n") + F.lit(k_host))
    h = hosts.select(F.col("host").alias("h"), host_rate.alias("host_rate"))
    both = paths.join(h, paths["host"].eqNullSafe(h["h"])).drop("h")
    k_path = both.agg(_strength(F.col("good") / F.col("n") - F.col("host_rate") + F.lit(mean), F.col("n"), F.lit(mean), F.count(F.lit(1))).alias("k")).first()["k"] or 50.0
    path_rate = (F.col("good") + F.lit(k_path) * F.col("host_rate")) / (F.col("n") + F.lit(k_path))
    return materialize(both.select("host", "path", F.round(path_rate, _ROUND).alias("path_rate"), F.round("host_rate", _ROUND).alias("host_rate")))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", carry: list[str] | None = None) -> DataFrame:
    """Posterior of every row: doc_id, held_out, host_rate, path_rate, llr, score, keep.

    ``carry`` names columns of ``docs`` to return whole, as (row, keep); the filtering
    pipeline uses it to pass rows through without a join on an id.
    """
    evidence = fit_evidence(docs, labels, id_col, text_col)
    slim = docs.select(F.col(host_col).alias("host"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    if carry is None:
        narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
        rows = materialize(evidence.score(with_evidence_features(narrow).drop("text")).select("doc_id", "host", "path", "llr"))
        rates = site_rates(rows, evidence.rate)
    else:
        scored = evidence.score(with_evidence_features(slim).drop("text")).select("host", "path", "llr")
        rates = site_rates(scored, evidence.rate)
        wrapped = docs.select(F.struct(*[F.col(c) for c in carry]).alias("row"), F.col(host_col).alias("host"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
        rows = evidence.score(with_evidence_features(wrapped).drop("text")).select("row", "host", "path", "llr")
    r = rates.select(F.col("host").alias("h"), F.col("path").alias("p"), "host_rate", "path_rate")
    out = rows.join(r, rows["host"].eqNullSafe(r["h"]) & rows["path"].eqNullSafe(r["p"])).drop("h", "p")
    logit = F.col("llr") + F.log(F.col("path_rate") / (1 - F.col("path_rate")))
    out = out.withColumn("score", F.round(1 / (1 + F.exp(-logit)), _ROUND)).withColumn("keep", F.col("score") >= 0.5)
    if carry is None:
        return out.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "host_rate", "path_rate", "llr", "score", "keep")
    return out.select("row", "keep")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, same columns."""
    return classify(docs, labels, carry=docs.columns).filter("keep").select("row.*")

"""Packing, mixing, quality and secrets on small tables with awkward rows."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from cohortflow.llm import mixing, packing, quality, secrets

DOCS = "doc_id bigint, text string, lang string, source string, size string, block int"
AWKWARD = [
    (1, "a b c", "en", "s1", "x", 1),
    (2, None, "en", "s1", None, 1),
    (3, "", None, "s2", "x", 2),
    (4, "one two three four five", "de", None, "x", 3),
    (4, "one two three four five", "de", None, "x", 3),
    (None, "w " * 5000, "fr", "s3", "x", 4),
    (None, None, None, None, None, None),
]


@pytest.fixture(scope="module")
def awkward(spark):
    # ``size`` and ``block`` clash with names the operators use inside.
    return spark.createDataFrame(AWKWARD, DOCS)


def brute_padding(lengths, bounds):
    return sum(min(b for b in bounds if b >= x) - x for x in lengths)


def test_bounds_are_optimal():
    lengths = [1, 1, 2, 5, 6, 6, 9, 14, 14, 20]
    values = sorted(set(lengths))
    counts = [lengths.count(v) for v in values]
    for k in range(1, 6):
        got = packing.optimal_bounds(values, counts, k)
        best = min(brute_padding(lengths, (*c, values[-1])) for c in itertools.combinations(values[:-1], min(k, len(values)) - 1))
        assert brute_padding(lengths, got) == best and got[-1] == 20 and len(got) <= k


def test_bounds_equal_the_plain_program():
    rnd = random.Random(6)
    for n in (1, 2, 7, 60):
        sizes, counts = sorted(rnd.sample(range(0, 500), n)), [rnd.randint(1, 4) for _ in range(n)]
        pad = lambda i, j: sum(c * (sizes[j] - x) for x, c in zip(sizes[i : j + 1], counts[i : j + 1], strict=True))  # noqa: E731, B023
        rows = [[(pad(0, j), 0) for j in range(n)]]
        for _ in range(1, min(5, n)):
            rows.append([min(((rows[-1][i - 1][0] if i else 0) + pad(i, j), i) for i in range(j + 1)) for j in range(n)])
        bounds, j = [], n - 1
        for row in reversed(rows):
            bounds, j = [sizes[j], *bounds], row[j][1] - 1
            if j < 0:
                break
        assert packing.optimal_bounds(sizes, counts, 5) == bounds


def test_one_long_document_leaves_the_other_bounds(spark):
    plain = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 150).alias("n_tokens"))
    long = spark.createDataFrame([(9000, 5_000_000)], "doc_id bigint, n_tokens bigint")
    without = {(r.doc_id, r.padded) for r in packing.pack(plain, n_buckets=15).collect()}
    both = {(r.doc_id, r.padded) for r in packing.pack(plain.unionByName(long), n_buckets=16).collect()}
    assert both == without | {(9000, 5_000_000)}


def test_packing_awkward_rows(awkward):
    rows = packing.pack_documents(awkward, n_buckets=2, budget=10).collect()
    assert len(rows) == len(AWKWARD)
    assert sorted(r.n_tokens for r in rows) == [0, 0, 0, 3, 5, 5, 5000]
    assert all(r.padded >= r.n_tokens for r in rows)
    slots = {(r.bucket, r.chunk, r.batch, r.slot) for r in rows}
    assert len(slots) == len(rows)
    for key in {(r.bucket, r.chunk, r.batch) for r in rows}:
        batch = [r for r in rows if (r.bucket, r.chunk, r.batch) == key]
        assert len(batch) == 1 or sum(r.padded for r in batch) <= 10


def test_packing_empty_table(awkward):
    assert packing.pack_documents(awkward.limit(0)).count() == 0


def test_water_filling(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 500), ("d", 0), (None, 90)]
    rows = {r.source: r for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, source_size bigint")).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True))
    total = 1.5 * sum(n for _, n in sizes)
    capped: set = set()
    while True:  # the contract's own loop: share the rest by weight until none is above
        left = total - sum(2 * rows[s].source_size for s in capped)
        free = [s for s in rows if s not in capped]
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * rows[s].source_size}
        if not over:
            break
        capped |= over
    for s, r in rows.items():
        assert r.target == pytest.approx(2 * r.source_size if s in capped else share[s])


def test_mixing_reaches_targets_and_repeats(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 40).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
    )
    a = mixing.mix_table(docs).collect()
    b = mixing.mix_table(docs.repartition(7)).collect()
    assert {(r.doc_id, r.taken) for r in a} == {(r.doc_id, r.taken) for r in b}
    assert all(0 <= r.taken <= 2 * r.size for r in a)
    source = {r.doc_id: r.source for r in docs.collect()}
    for s in set(source.values()):
        mine = [r for r in a if source[r.doc_id] == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 1
        assert sum(r.size for r in mine) == mine[0].source_size


def test_splitting_tree_keeps_quotas(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("w w w").alias("text"), F.concat(F.lit("s"), F.col("id") % 4).alias("source"))
    sources, draws = mixing.plan(mixing.size_documents(docs), levels=3)
    per_shard = {r.shard: r["count"] for r in draws.groupBy("shard").count().collect()}
    assert sorted(per_shard) == list(range(8)) and max(per_shard.values()) - min(per_shard.values()) <= 1
    assert draws.select("source", "block", "copy").distinct().count() == draws.count()
    mixed = mixing.mixture(mixing.size_documents(docs), levels=3)
    shards = mixing.shuffled_shards(mixed)
    assert shards.agg(F.sum("words")).first()[0] == pytest.approx(9000, abs=4)


def test_shards_follow_the_hypergeometric_law(spark):
    # 4096 draws, 1024 of them from one source, split into 64 shards of 64.
    draws = spark.range(4096).select(F.when(F.col("id") < 1024, "a").otherwise("b").alias("source"), F.col("id").cast("int").alias("block"), F.lit(1).alias("copy"))
    got = mixing.split_quotas(draws, 6).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("source") == "a").alias("a")).collect()
    assert len(got) == 64 and {r.n for r in got} == {64} and sum(r.a for r in got) == 1024
    variance = 64 * 0.25 * 0.75 * (4096 - 64) / 4095
    # Chi-square with 63 degrees of freedom, bounds at about 0.001 on either side.
    assert 33 < sum((r.a - 16) ** 2 for r in got) / variance < 104


def test_mix_query_returns_the_shards(spark, monkeypatch):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 9).cast("int")).alias("text"), F.substring("id", 1, 1).alias("source"))
    few = mixing.mix_table(docs, levels=3).collect()
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 1)
    monkeypatch.setattr(mixing, "MIN_BLOCKS", 5)
    sized = mixing.size_documents(docs)
    sources, _ = mixing.plan(sized, levels=3)
    total = sum(r.source_size for r in sources.collect())
    assert total <= sum(r.n_blocks for r in sources.collect()) <= total + 10
    for rows in (few, mixing.mix_table(docs, levels=3).collect()):
        shards = set()
        for r in rows:
            drawn = [tuple(map(int, x.split(":"))) for x in r.shards.split(",") if x]
            assert sum(w for _, _, w in drawn) == r.taken and [c for c, _, _ in drawn] == sorted({c for c, _, _ in drawn})
            shards |= {s for _, s, _ in drawn}
        assert shards == set(range(8))


def test_mixing_awkward_rows(awkward):
    rows = mixing.mix_table(awkward).collect()
    assert len(rows) == len(AWKWARD) and sum(r.size for r in rows) == 5013
    assert all(r.taken == 0 for r in rows if r.size == 0)
    assert mixing.mix_table(awkward.limit(0)).count() == 0
    whole = mixing.mixed_rows(awkward)
    assert whole.columns == awkward.columns and whole.count() >= 4


LABELS = "doc_id bigint, quality int, toxic int"


def quality_docs(spark):
    good = [(i, f"This is a plain sentence number {i} about many different things and more.", "en", f"h{i % 3}") for i in range(60)]
    bad = [(100 + i, f"BUY!! NOW!! {'$$$ ### ' * 9}{i}", "en", f"h{i % 3}") for i in range(20)]
    docs = spark.createDataFrame(good + bad, "doc_id bigint, text string, lang string, source string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(20)], LABELS)
    return docs, labels


def test_quality_separates_and_shrinks(spark):
    docs, labels = quality_docs(spark)
    rows = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert all(rows[i].keep for i in range(60)) and not any(rows[100 + i].keep for i in range(20))
    assert quality.keep_good(docs, labels).columns == docs.columns
    # A site with one document stays near its parent's rate.
    one = docs.unionByName(spark.createDataFrame([(500, "BUY!! $$$ ###", "en", "lonely")], docs.schema))
    lonely = [r for r in quality.classify(one, labels).collect() if r.doc_id == 500][0]
    assert lonely.host_rate > 0.3


def test_quality_awkward_rows(spark, awkward):
    docs, labels = quality_docs(spark)
    assert quality.classify(awkward, labels.limit(0)).filter("keep").count() == len(AWKWARD)
    assert quality.classify(awkward.limit(0), labels).count() == 0
    mixed = awkward.select("doc_id", "text", "lang", "source").unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000))
    both = labels.withColumn("doc_id", F.col("doc_id") + 1000)
    assert quality.classify(mixed, both).count() == mixed.count()


def test_secret_spans_and_decisions(spark):
    key = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    texts = [
        (1, f'lead text token = "{key}" and more'),
        (2, "a card number 4785380592391139 in the text"),
        (3, f"commit {key} of the tree"),
        (4, None),
        (5, ""),
        (6, f'x token = "{key}" y token = "{key}"'),
        (None, f'password = "{key[::-1]}"'),
    ]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("start", F.lit("clash"))
    found = secrets.scan(docs).collect()
    by_text = dict(texts)
    for r in found:
        assert by_text[r.doc_id][r.start : r.start + len(r.candidate)] == r.candidate
    decided = {(r.doc_id, r.n): r.is_secret for r in found}
    assert decided == {(1, 0): True, (2, 0): False, (3, 0): False, (6, 0): True, (6, 1): True, (None, 0): True}
    clean = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert clean[1] == 'lead text token = "[SECRET]" and more' and clean[3] == by_text[3] and clean[4] is None
    assert clean[6].count("[SECRET]") == 2


def test_short_and_odd_secrets_are_found(spark):
    texts = {
        1: ('set password = "hunter2secret" here', "hunter2secret"),
        2: ("password: P@ssw0rd!2024#abcdXYZ99, then", "P@ssw0rd!2024#abcdXYZ99"),
        3: ("use postgres://app:pa55w0rdXk9@db now", "pa55w0rdXk9"),
        4: ("api_key=AbCdEfGhIjKlMnOpQr\nend", "AbCdEfGhIjKlMnOpQr"),
        5: ("git clone https://ghp_a8Kd03mZx7Qw5Lr2Ty9Bv4Nc6Hj1Gf0Ps3Ue@github.com/x", "ghp_a8Kd03mZx7Qw5Lr2Ty9Bv4Nc6Hj1Gf0Ps3Ue"),
    }
    plain = {10: "author: Johnson wrote it", 11: "write to mailto:john.smith@example.com soon", 12: "the token: something else", 13: "Passwort: nein, Secret: nothing"}
    docs = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()] + list(plain.items()), "doc_id bigint, text string")
    clean = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    for i, (text, secret) in texts.items():
        assert secret not in clean[i] and "[SECRET]" in clean[i], clean[i]
    assert clean[2] == "password: [SECRET], then" and clean[3] == "use postgres://app:[SECRET]@db now"
    assert {i: clean[i] for i in plain} == plain


def test_many_bare_tokens_are_not_taught_away(spark):
    token = F.concat(F.lit("ghp_"), F.substring(F.translate(F.base64(F.unhex(F.sha2(F.col("id").cast("string"), 256))), "+/=", "xyz"), 1, 36))
    bare = spark.range(1500).select(F.col("id").alias("doc_id"), F.concat(F.lit("row, "), token, F.lit(", next")).alias("text"))
    commits = spark.range(2000, 2300).select(F.col("id").alias("doc_id"), F.concat(F.lit("commit "), F.sha1(F.col("id").cast("string"))).alias("text"))
    decided = {(r.doc_id < 2000, r.is_secret) for r in secrets.scan(bare.unionByName(commits)).select("doc_id", "is_secret").distinct().collect()}
    assert decided == {(True, True), (False, False)}


def test_secrets_empty_table(spark):
    assert secrets.scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_redaction_hits_the_place_not_the_word(spark):
    text = 'password = "hunter2secret"; hunter2secret is a nickname, hunter2secrets too'
    rows = [(1, text), (2, "hunter2secret is a nickname"), (3, text), (None, text), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for c in ("_key", "_secrets", "_text_key", "row", "flags", "salt", "text_key", "n"):
        docs = docs.withColumn(c, F.lit(f"own {c}"))
    got = sorted((tuple(r) for r in secrets.redact(docs).collect()), key=repr)
    cut = text.replace('"hunter2secret"', '"[SECRET]"')
    texts = {1: cut, 2: rows[1][1], 3: cut, None: cut, 4: None, 5: ""}
    assert got == sorted(((i, texts[i], *[f"own {c}" for c in docs.columns[2:]]) for i, _ in rows), key=repr)


def test_many_candidates_in_one_text(spark):
    """Work in proportion to the text: 100,000 candidates of one document, each at its offset."""
    rnd = random.Random(3)
    token = lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(24))
    text = "é " + " ".join(token() for _ in range(100_000)) + f' api_key = "{token()}AbZ" end'
    docs = spark.createDataFrame([(1, text), (2, "plain words only")], "doc_id bigint, text string")
    found = secrets.candidates(docs).collect()
    assert sorted(r.n for r in found) == list(range(100_001))
    assert all(text[r.start : r.start + len(r.candidate)] == r.candidate for r in found)
    clean = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert clean[2] == "plain words only" and clean[1].endswith('api_key = "[SECRET]" end')


def test_repeated_rows_are_scanned_one_by_one(spark):
    docs = spark.createDataFrame([(1, 'token = "0a1b2c3d4e5f6a7b8c9d0e1f"')] * 3, "doc_id bigint, text string")
    assert [r.start for r in secrets.scan(docs).collect()] == [9, 9, 9]
    assert {r.text for r in secrets.redact(docs).collect()} == {'token = "[SECRET]"'} and secrets.redact(docs).count() == 3


def test_packing_the_mix_keeps_copies_apart(spark):
    rnd = random.Random(6)
    rows = [(i, "w " * rnd.randint(1, 40) + str(i)) for i in range(120)]
    rows = rows + rows[:100] + rows[:30] + [(None, "no id"), (None, "no id"), (7, "another text of id 7"), (500, None), (500, "")]
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for c in ("copy", "chunk", "place", "bucket", "n_tokens", "text_key"):
        docs = docs.withColumn(c, F.lit("clash"))
    got = packing.pack_mixed(docs, n_buckets=4, budget=400).collect()
    assert len(got) == len(rows)
    batches = {}
    for r in got:
        batches.setdefault((r.bucket, r.chunk, r.copy, r.batch), []).append(r)
    for members in batches.values():
        assert len({(r.doc_id, r.text_key) for r in members}) == len(members)  # never two copies
        assert sorted(r.slot for r in members) == list(range(len(members)))
        assert len(members) * members[0].padded <= 400 or len(members) == 1
        assert all(r.n_tokens <= r.padded for r in members)
    keys = [(r.doc_id, r.text_key, r.copy) for r in got]
    assert len(set(keys)) == len(keys)
    assert packing.pack_mixed(docs.limit(0)).count() == 0


def test_packing_spreads_rows_without_an_id(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 50)
    lengths = spark.range(400).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(3).cast("bigint").alias("n_tokens"))
    found = packing.pack(lengths, 2, 30).groupBy("chunk").count().collect()
    assert len(found) == 8 and max(r["count"] for r in found) <= 60

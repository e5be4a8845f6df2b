"""Periodic runs, sketches and hard negatives against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortflow.llm import negatives, runs, sketches

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = "doc_id bigint, text string"


# --- runs ------------------------------------------------------------------


def plain_runs(words, least=12):
    """Every maximal stretch of every period, smallest period first."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        x = 0
        while x + q < len(words):
            e = x
            while e + q < len(words) and words[e] == words[e + q]:
                e += 1
            if e > x and e + q - x >= max(least, 2 * q):
                found.setdefault((x, e + q), q)
            x = e + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def odd_words(rnd, n):
    """Words with nested, touching and broken repeats."""
    kind, a = rnd.randint(0, 4), rnd.choice([1, 2, 3, 30])
    unit = [rnd.randint(0, a) for _ in range(rnd.randint(1, 14))]
    if kind == 0:
        return [rnd.randint(0, a) for _ in range(n)]
    if kind == 1:
        f = [[0], [0, 1]]
        while len(f[-1]) < n + 1:
            f.append(f[-1] + f[-2])
        return f[-1][:n]
    if kind == 2:
        return (unit * (n + 1))[:n]
    out = []
    while len(out) < n:
        out += unit * rnd.randint(1, 9) + unit[: rnd.randint(0, len(unit))]
        if kind == 3:
            unit = [rnd.randint(0, a) for _ in range(rnd.randint(1, 9))]
        elif rnd.random() < 0.3:
            out.append(rnd.randint(0, a))
    return out[:n]


def test_runs_equal_plain_search():
    rnd = random.Random(7)
    total = 0
    for _ in range(150):
        documents = [[b"%d" % x for x in odd_words(rnd, rnd.randint(0, 150))] for _ in range(rnd.randint(1, 5))]
        for words, got in zip(documents, runs.word_runs(documents), strict=True):
            want = plain_runs(words)
            assert got == want, b" ".join(words)
            total += len(want)
    assert total > 1000


def plain_digest(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None, None, None)
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest(),
    )


def test_run_digests(spark, monkeypatch):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([" ", "\n", "\t ", "\x0b"]).join(f"w{x}" for x in odd_words(rnd, rnd.randint(0, 90)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "a\xa0b\x1fc " * 8), (None, "x y " * 9), (5, "again " * 20), (5, "again " * 20), (-3, "n e g " * 30)]
    monkeypatch.setattr(runs, "GROUP", 500)
    docs = spark.createDataFrame(rows, TEXTS).withColumn("start", F.lit("clash")).withColumn("n_runs", F.lit(None).cast("int")).repartition(3)
    got = sorted((tuple(r) for r in runs.run_digests(docs).collect()), key=repr)
    assert got == sorted((plain_digest(*r) for r in rows), key=repr)
    assert runs.run_digests(docs.limit(0)).count() == 0


def test_runs_of_very_long_texts(spark):
    # One run of a million words, one long text without any, a long period that just fits.
    unit = [f"u{i}" for i in range(40_000)]
    rows = [(1, "la " * 1_000_000), (2, " ".join(f"w{i}" for i in range(400_000))), (3, " ".join(unit + unit + ["end"]))]
    got = {r.doc_id: r for r in runs.collapse_runs(spark.createDataFrame(rows, TEXTS)).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 1_000_000, 1)] and got[1].collapsed == "la"
    assert got[2].runs == [] and got[2].n_words == 400_000
    assert [tuple(r) for r in got[3].runs] == [(0, 80_000, 40_000)] and got[3].collapsed == " ".join(unit + ["end"])


# --- sketches --------------------------------------------------------------


def shingles(text):
    b = (text or "").encode()
    return {b[i : i + sketches.WIDTH] for i in range(max(1, len(b) - sketches.WIDTH + 1))} if b else set()


def plain_edited(rows):
    """Edited text and next text of every row, by the contract's words."""
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    out = []
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        out.append((i, text, text[: len(text) - half] + after[:half], after))
    return out


def test_edited_likeness(spark):
    rnd = random.Random(2)
    say = lambda n: " ".join(rnd.choice("añbçdé中😀xyz") * rnd.randint(1, 4) + str(rnd.randint(0, 9999)) for _ in range(n))
    rows = [(i * 3 - 40, say(rnd.choice([1, 3, 30, 400, 3000]))) for i in range(90)]
    rows += [(1001, None), (1002, ""), (1003, "x"), (1004, "same " * 60), (1005, "same " * 60), (2**60, say(200)), (2**60 + 1, say(200))]
    extra = [(None, "no place in the order"), (None, None)]
    docs = spark.createDataFrame(rows + extra, TEXTS).withColumn("part", F.lit("clash")).withColumn("id", F.lit(1.5)).repartition(5)
    for parts in (1, 7, 40):
        got = {r.doc_id: r for r in sketches.edited_likeness(docs, n_parts=parts).collect()}
        assert len(got) == len(rows) + 1  # both rows without an id share a key here
        for i, text, edited, after in plain_edited(rows):
            r = got[i]
            assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest()), i
            a, e, n = shingles(text), shingles(edited), shingles(after)
            for est, x in ((r.near_edited, e), (r.near_next, n)):
                true = len(a & x) / len(a | x) if a | x else 1.0
                assert 0 <= est <= 1 and abs(est - true) <= (1e-12 if max(len(a), len(x)) <= sketches.FLOOR else 0.25), (i, est, true)
    assert got[1004].fingerprint == got[1005].fingerprint and got[1004].near_next == 1
    assert (got[1001].fingerprint, got[1001].near_next) == ("-", 1.0)
    assert sketches.edited_likeness(docs.limit(0)).count() == 0
    one = sketches.edited_likeness(docs.filter("doc_id = 1004")).collect()[0]
    assert (one.near_edited, one.near_next) == (1.0, 1.0)  # its own next document


def test_rows_sharing_an_id_keep_one_order(spark):
    rows = [(1, "first text"), (2, "b " * 50), (2, "a " * 60), (2, "b " * 50), (3, "last text")]
    docs = spark.createDataFrame(rows, TEXTS)
    runs_ = [sorted(tuple(r) for r in sketches.edited_likeness(docs.repartition(k), n_parts=k).collect()) for k in (1, 2, 5)]
    assert len(runs_[0]) == 5 and runs_[0] == runs_[1] == runs_[2]


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(0)
    say = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes()
    small, rest = say(4000), say(400_000)
    a, b, both = sketches.sketch_all([small, rest, small + b"|" * 7 + rest])
    merged = sketches.merge(a, b)
    assert merged[0] == "f" and len(np.setxor1d(merged[1], both[1])) <= 3  # the seam's shingles
    like, share, back = sketches.compare(a, both)
    assert share == 1.0 and abs(like - 0.01) < 0.005 and abs(back - 0.01) < 0.005
    # The kept share is the fixed fraction; a short text keeps FLOOR hashes, a tiny one all.
    assert abs(len(b[1]) / 400_000 - 1 / sketches.SCALE) < 0.002
    kinds = [k for k, _ in sketches.sketch_all([say(1500), say(40), b"abc", b"", b"ab" * 1_500_000])]
    assert kinds == ["k", "a", "a", "-", "a"]
    for s in (a, b, *sketches.sketch_all([say(1500), b"abc", b""])):
        again = sketches.decode(sketches.encode(s))
        assert again[0] == s[0] and (again[1] == s[1]).all() and sketches.merge(s, s)[1].tolist() == s[1].tolist()
    # Cutting a text into buffers changes nothing.
    whole = sketches.sketch_all([rest])[0]
    old, sketches._BUFFER = sketches._BUFFER, 5000
    try:
        assert (sketches.sketch_all([b"", rest, small])[1][1] == whole[1]).all()
    finally:
        sketches._BUFFER = old


# --- hard negatives --------------------------------------------------------


def plain_negatives(rows):
    out = []
    for i, label, x in rows:
        if i % 50:
            continue
        score = [(sum(p * q for p, q in zip(x, y, strict=False)), j, m) for j, m, y in rows if j != i]
        best = sorted((-s, j) for s, j, m in score if m == label)[:5]
        for s, j in best:
            found = sorted((-t, k) for t, k, m in score if m != label and 50 * -s <= 100 * t <= 95 * -s)[:3]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(found)]
    return sorted(out)


def vector_rows(seed, n=700, dims=20, hot=250):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dims)) + 2.0 * rng.standard_normal((8, dims))[rng.integers(0, 8, n)]
    x[:hot] = x[0]  # one vector held by a third of the rows: ties
    label = rng.integers(0, 4, n)
    return [(int(i), None if i % 97 == 5 else int(m), [float(v) for v in r]) for i, m, r in zip(range(n), label, x.astype(np.float32), strict=True)]


AWKWARD = [
    (10_000, 1, None), (10_050, 1, [None, 1.0]), (10_100, 2, [float("nan")] * 20), (10_150, 2, [float("inf")] * 20), (10_200, None, [1.0] * 20),
    (None, 1, [1.0] * 20), (10_250, 3, []), (10_300, 3, [0.0] * 20), (10_350, 77, [1.0] * 20), (10_400, 2, [3.0, 1.0]), (10_450, 1, [1e30] + [0.0] * 19), (-50, 1, [1.0] * 20),
]


@pytest.mark.parametrize("seed", [0, 1])
def test_negatives_equal_plain_search(spark, monkeypatch, seed):
    monkeypatch.setattr(negatives, "CHUNK", 64)
    monkeypatch.setattr(negatives, "PACK", 3)
    rows = vector_rows(seed) + AWKWARD
    table = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").withColumn("slot", F.lit("clash")).withColumn("g", F.lit("clash")).repartition(4)
    got = sorted(tuple(r) for r in negatives.mine(negatives.usable_rows(negatives.relabelled(table)), F.col("vec_id") % 50 == 0, n_groups=5).collect())
    skip = {10_000, 10_050, 10_100, 10_150, 10_200, 10_450, None}
    plain = [(i, (m + 1) % 10 if i % 7 == 0 else m, [int(np.floor(256 * np.float64(np.float32(v)))) for v in x]) for i, m, x in rows if i not in skip and m is not None]
    want = plain_negatives(plain)
    assert got == want and len(want) > 40


def test_negatives_repeated_rows_and_empty_table(spark):
    rows = vector_rows(3, n=120, hot=10)
    one = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    ask = lambda t: sorted(tuple(r) for r in negatives.mine(negatives.usable_rows(t), F.col("vec_id") % 50 == 0).collect())
    assert ask(one.unionAll(one)) == ask(one) != []
    assert negatives.mine(negatives.usable_rows(one.limit(0)), F.col("vec_id") % 50 == 0).count() == 0


def test_bounds_hold_at_every_level():
    rng = np.random.default_rng(4)
    a, x = np.floor(300 * rng.standard_normal((20, 32))), np.floor(300 * rng.standard_normal((50, 32)))
    true, wider = a @ x.T, None
    for s in negatives.LEVELS:
        (am, ad), (xm, xd) = negatives.summary(a, s), negatives.summary(x, s)
        middle, spread = (32 // s) * (am @ xm.T), (32 // s) * (ad @ xd.T)
        assert (np.abs(true - middle) <= spread + 1e-6).all()
        if wider is not None:
            assert (middle + spread <= wider + 1e-6).all()  # finer segments never bound worse
        wider = middle + spread
    group = negatives.RowGroup(np.arange(50), np.zeros(50, dtype=np.int64), x)
    assert (group.reach(*negatives.summary(a, negatives.LEVELS[0])) >= true.max(axis=1)).all()

"""Near-duplicates, toxicity, language and token counts against plain versions."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortflow.llm import langid, minhash, tokens, toxicity
from cohortflow.llm.components import connected_components
from cohortflow.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "WORD"), (5, "word"), (None, "word"), (6, "É É"), (7, "x" * 300_000), (8, "long " * 60_000)]


def plain_set(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(zip(*[w[i:] for i in range(width)], strict=False)) if len(w) >= width else frozenset([tuple(w)])


def plain_components(rows, width, percent):
    sets = [(i, plain_set(t, width)) for i, t in rows if i is not None]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    smallest = {}
    for k, (i, _) in enumerate(sets):
        smallest[root(k)] = min(smallest.get(root(k), i), i)
    return sorted((i, len(s), smallest[root(k)]) for k, (i, s) in enumerate(sets))


def near_copies():
    rnd = random.Random(3)
    rows = []
    for g in range(12):
        base = [rnd.choice("abcdefghij") + str(rnd.randint(0, 400)) for _ in range(rnd.choice([4, 9, 30, 200]))]
        for _ in range(rnd.randint(1, 14)):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 12))):
                w[rnd.randrange(len(w))] = "new" + str(rnd.randint(0, 9999))
            rows.append(" ".join(w))
    rnd.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)] + [(900, rows[0].upper()), (901, rows[0])]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_brute_force(spark, width):
    rows = near_copies() + [(i + 2000, t) for i, t in AWKWARD if i is not None and len(t or "") < 100]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("rep", F.lit("clash"))
    got = minhash.near_duplicates(docs, width=width).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(rows, width, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("block", [3, 512])
def test_rare_shingles_find_every_link(spark, monkeypatch, block):
    # No bucket is small: every comparison between components goes by rare shingles.
    monkeypatch.setattr(minhash, "_NEAR", 0)
    monkeypatch.setattr(minhash, "_BLOCK", block)
    rows = near_copies()
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), width=2).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(rows, 2, 80)


def test_rare_shingles_leave_out_no_pair(spark):
    rnd, sets = random.Random(8), {}
    for g in range(25):
        base = rnd.sample(range(300), rnd.choice([1, 2, 5, 9, 30, 90]))
        for _ in range(6):
            some = set(base) - set(rnd.sample(base, rnd.randint(0, len(base) // 4))) | {rnd.randint(0, 10**6) for _ in range(rnd.randint(0, len(base) // 5))}
            sets[len(sets)] = sorted(some)
    rows = [(k, np.array(v, dtype=np.uint64).tobytes()) for k, v in sets.items()]
    full = spark.createDataFrame([(k, bytearray(b)) for k, b in rows], "rep bigint, shingles binary")
    reps = spark.createDataFrame([(k, len(v), k) for k, v in sets.items()], "rep bigint, n_shingles bigint, comp bigint")
    found = {(r.a, r.b) for r in minhash._prefix_candidates(reps, full, 80).collect()}
    for a in sets:
        for b in range(a + 1, len(sets)):
            x, y = set(sets[a]), set(sets[b])
            assert (a, b) in found or 100 * len(x & y) < 80 * len(x | y)


def test_documents_of_one_template_are_not_paired(spark):
    # 82 % of every set is the template: similarity 0.7, no link, and no candidate either.
    def candidates(n):
        rnd = np.random.default_rng(n)
        shared = np.arange(1, 165, dtype=np.uint64)
        full = [(k, bytearray(np.concatenate((shared, rnd.integers(1000, 2**62, 36).astype(np.uint64))).tobytes())) for k in range(n)]
        reps = spark.createDataFrame([(k, 200, k) for k in range(n)], "rep bigint, n_shingles bigint, comp bigint")
        return minhash._prefix_candidates(reps, spark.createDataFrame(full, "rep bigint, shingles binary"), 80).count()

    assert candidates(300) == candidates(900) == 0


def test_tiny_sets_are_compared_exactly(spark):
    # Pairs of 5 and 4 shingles at 0.8 whose signatures agree in less than SIGNATURE_MIN.
    rnd, rows = random.Random(12), []
    while len(rows) < 4:
        words = [f"w{rnd.randint(0, 10**6)}" for _ in range(6)]
        pair = [" ".join(words), " ".join(words[:5])]
        (sa, fa), (sb, fb) = (minhash.minima(s) for s in shingle_sets([t.encode() for t in pair], 2))
        if minhash._share_equal(minhash._bytes(sa, fa), minhash._bytes(sb, fb)) < minhash.SIGNATURE_MIN:
            rows += [(len(rows), pair[0]), (len(rows) + 1, pair[1])]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), width=2).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(0, 0), (1, 0), (2, 2), (3, 2)]


def test_near_duplicates_awkward_rows(spark):
    got = minhash.near_duplicates(spark.createDataFrame(AWKWARD, "doc_id bigint, text string"), width=2).collect()
    assert len(got) == len(AWKWARD)
    by = {r.doc_id: r for r in got}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0
    assert by[4].component_id == by[5].component_id == 4 and by[8].n_shingles == 1
    assert by[None].component_id is None and by[None].kept
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert minhash.near_duplicates(empty).count() == 0


def test_shingles_across_buffers(monkeypatch):
    import cohortflow.llm.shingles as sh

    text = ("alpha Beta\tgamma\x0bdelta " * 50 + "y" * 200 + " end ").encode()
    whole = shingle_sets([text, b"", b"one"], 3)
    monkeypatch.setattr(sh, "_BUFFER", 64)
    monkeypatch.setattr(sh, "_powers", {})
    cut = shingle_sets([text, b"", b"one"], 3)
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))
    assert len(whole[0]) == len(plain_set(text.decode(), 3)) and len(whole[1]) == 0 and len(whole[2]) == 1


def test_densified_bins_are_full():
    values = np.sort(np.random.default_rng(0).integers(0, 2**63, 5).astype(np.uint64) * np.uint64(2))
    sig, full = minhash.minima(values)
    assert set(minhash.densified(sig, full).tolist()) == set(values.tolist()) & set(sig[full].tolist())


def test_connected_components(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(0, 200) if i % 50 != 49] + [(500, 501), (501, 500), (7, 7), (None, 3)] + [(1000, rnd.randint(1001, 1300)) for _ in range(300)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got[49] == 0 and got[50] == 50 and got[99] == 50 and got[501] == 500
    assert all(got[x] == 1000 for x in got if x >= 1000)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def toxic_docs():
    rnd = random.Random(2)
    docs, labels = [], []
    for i in range(400):
        w = [rnd.choice("the and of with more words here about some topic clown".split()[:-1]) for _ in range(rnd.randint(10, 60))]
        label = int(i % 4 == 0)
        if label:
            for _ in range(rnd.randint(2, 4)):
                w[rnd.randrange(len(w))] = rnd.choice(["idiot", "Moron!", "scum"]) if i % 8 else "zork" + rnd.choice(["a", "en", "ist"])
        docs.append((i, " ".join(w)))
        labels.append((i, 1, label))
    return docs, labels


def test_toxicity_learns_words_and_stems(spark):
    docs, labels = toxic_docs()
    extra = [(1000, "you 1d10t and m0r0n"), (1001, "уоu іdіоt ѕcum"), (1002, "the clown fish swims with the class clown"), (1003, "Idio­t scu​m"), (1004, "wide mineral scumble and sidiotic")]
    d = spark.createDataFrame(docs + extra, "doc_id bigint, text string").withColumn("weight", F.lit("clash"))
    found = {r.doc_id: r for r in toxicity.score(d, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()}
    right = [found[i].predicted == t for i, _, t in labels]
    assert sum(right) / len(right) > 0.98
    assert found[1000].predicted and found[1001].predicted and found[1003].predicted
    assert not found[1002].predicted and not found[1002].terms and not found[1004].predicted


def test_disguised_repeats_count():
    a = toxicity.Lexicon({"idiot": 1.0, "moron": 1.0}).automaton()
    terms = lambda t: sorted(m[2] for m in toxicity.matches(a, t))
    assert terms("idiot 1d10t 1d1ot m0r0n") == ["idiot"] * 3 + ["moron"]
    assert terms("idiot IDIOT ídiot 1d10t") == ["idiot"] * 4
    assert terms("idiot and 10 idiot") == ["idiot"] * 2 and terms("1d10t") == ["idiot"]


def test_shields_equal_the_plain_rule_and_stay_linear():
    import time

    a = toxicity.Lexicon({"idiot": 1.0, "stupid": 1.0, "simple stupid idiot": 2.0}, exceptions=("idiot proof", "stupid simple", "not stupid", "simple stupid")).automaton()
    rnd = random.Random(4)
    for _ in range(300):
        text = " ".join(rnd.choice(["idiot", "proof", "stupid", "simple", "not", "a"]) for _ in range(rnd.randint(0, 30)))
        hits, shields = [], []
        for phrase, kind in (("idiot", 0), ("stupid", 0), ("simple stupid idiot", 0), ("idiot proof", 1), ("stupid simple", 1), ("not stupid", 1), ("simple stupid", 1)):
            for m in re.finditer(rf"(?=\b{phrase}\b)", text):
                (shields if kind else hits).append((m.start(), m.start() + len(phrase)))
        want = sorted(h for h in hits if not any(s <= h[0] and h[1] <= e for s, e in shields))
        assert sorted((m[0], m[1]) for m in toxicity.matches(a, text)) == want
    began = time.process_time()
    assert toxicity.matches(a, "idiot proof " * 100_000) == []
    assert time.process_time() - began < 10


def test_toxicity_awkward_rows(spark):
    docs = spark.createDataFrame([r for r in AWKWARD], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = toxicity.score(docs, none).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted == 0 for r in rows)
    assert toxicity.score(docs.limit(0), none).count() == 0


LANGS = {"en": "the quick brown fox jumps over the lazy dog and then walks home again", "de": "der schnelle braune fuchs springt über den faulen hund und geht nach hause", "fr": "le vif renard brun saute par-dessus le chien paresseux et rentre à la maison"}


def test_code_lengths_equal_a_plain_model():
    sample = {k: [v.encode()] * 3 for k, v in LANGS.items()}
    trees = langid.build_trees(sample, order=3, alphabet=20)
    text = ("the fuchs saute " * 80 + "żółw").encode()  # longer than one segment

    def plain(lang):
        counts = [{} for _ in range(4)]
        for t in sample[lang]:
            s = trees.symbol[np.frombuffer(t, dtype=np.uint8)].tolist()
            for k in range(4):
                for i in range(len(s) - k):
                    counts[k].setdefault(tuple(s[i : i + k]), {}).setdefault(s[i + k], 0)
                    counts[k][tuple(s[i : i + k])][s[i + k]] += 1
        bits, s = 0.0, trees.symbol[np.frombuffer(text, dtype=np.uint8)].tolist()
        for i, x in enumerate(s):
            for k in range(min(3, i), -2, -1):
                if k < 0:
                    bits += np.log2(20)
                    break
                seen = counts[k].get(tuple(s[i - k : i]))
                if not seen:
                    continue
                n, d = sum(seen.values()), len(seen)
                if x in seen:
                    bits += np.log2((n + d) / seen[x])
                    break
                bits += np.log2((n + d) / d)
            bits += trees.other_bits * (x == 19)
        return bits

    got = trees.code_lengths([text, b""])
    assert got[0] == pytest.approx([plain(x) for x in trees.languages], rel=1e-5) and (got[1] == 0).all()


def test_language_sample_counts_copies_once_and_cuts_long_texts(spark):
    rows = [(None, "the same text again " * 5, "en")] * 500 + [(None, f"text number {i} of many", "en") for i in range(30)]
    rows += [(None, "ein langer Text \u00fc\u00f1\u4e2d\U0001f600\n" * 200, "de")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = [(r.lang, r.text) for r in langid.training_sample(docs, sample_bytes=4000).collect()]
    assert len(got) == len(set(got)) and sum(g[0] == "en" for g in got) == 31
    long = [t for k, t in got if k == "de"]
    assert long and all(t in rows[-1][1] and len(t.encode()) <= 1000 for t in long) and sum(len(t.encode()) for t in long) <= 4000


def test_languages_awkward_rows(spark):
    rows = [(i, " ".join(random.Random(i).sample(LANGS[k].split(), 9)), k) for i, k in enumerate(["en", "de", "fr"] * 40)]
    awkward = [(1000, None, "en"), (1001, "", "en"), (1002, "123 !!! 456", "en"), (None, LANGS["de"], None), (1003, LANGS["fr"] * 3000, None)]
    docs = spark.createDataFrame(rows + awkward, "doc_id bigint, text string, lang string").withColumn("score", F.lit("clash"))
    got = {r.doc_id: r for r in langid.predict_languages(docs).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows)
    assert got[1000].lang_pred == got[1001].lang_pred == got[1002].lang_pred == "und" and got[1002].score == 0
    assert got[None].lang_pred == "de" and got[1003].lang_pred == "fr"
    assert langid.predict_languages(docs.limit(0)).count() == 0
    unlabelled = langid.predict_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def small_vocabulary():
    pieces = [("<unk>", 0.0), ("<s>", 0.0), ("</s>", 0.0)] + [(f"<0x{i:02X}>", 0.0) for i in range(256)]
    words = ["▁", "▁▁", "a", "b", "ab", "ba", "aba", "▁a", "▁ab", "abab", "é", "c", "bc"]
    return pieces + [(w, -float(1 + (3 * k) % 5)) for k, w in enumerate(words)]


def reference_counter(vocabulary):
    from tokenizers import Tokenizer, models, normalizers

    t = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return lambda text: len(t.encode(text, add_special_tokens=False).ids) if text else 0


def test_token_counts_equal_the_tokenizer():
    vocabulary = small_vocabulary()
    counter, reference = tokens.Counter(vocabulary), reference_counter(vocabulary)
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("ab c é\n日z") for _ in range(rnd.randint(0, 60))) for _ in range(500)] + ["  a  ", " ", "\n", "ab" * 2000]
    assert [counter.count(t) for t in texts] == [reference(t) for t in texts]


def test_token_counts_with_the_public_file(spark):
    import os

    if not os.path.exists(tokens.VOCABULARY):
        pytest.skip("no vocabulary file here")
    reference = reference_counter(tokens.read_vocabulary())
    rows = [r for r in AWKWARD if len(r[1] or "") < 1000] + [(20, "hello world, this  is   wörthless\nÉéanon 漢字 <s>"), (21, LANGS["de"] * 40)]
    got = tokens.count_tokens(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in got) == sorted((i or -1, reference(t)) for i, t in rows)
    assert tokens.count_tokens(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_parity_bits_never_rule_out_too_much():
    rnd = np.random.default_rng(5)
    for n in (1, 30, 400, 4000):
        base = rnd.integers(0, 2**63, n).astype(np.uint64)
        sets = [np.unique(np.concatenate((base[rnd.random(n) < keep], rnd.integers(0, 2**63, n // 5).astype(np.uint64)))) for keep in (1.0, 0.9, 0.5)]
        bits = [minhash.parity_bits(x).tobytes() for x in sets]
        x, y = np.nonzero(np.ones((3, 3), dtype=bool))
        apart = minhash._at_least_apart(bits, bits, x, y)
        assert all(d <= len(np.setxor1d(sets[i], sets[j])) for d, i, j in zip(apart, x, y, strict=True))
    assert list(minhash._at_least_apart([b""], bits, np.array([0]), np.array([1]))) == [0]


def test_crowd_below_the_threshold_makes_no_rows(spark):
    # Each set lacks its own 15 of 100 shared shingles: similarities around 0.74, and every pair has rare shingles in common.
    rnd = np.random.default_rng(3)
    shared = rnd.integers(0, 2**63, 100).astype(np.uint64)
    sets = [np.sort(rnd.permutation(shared)[:85]) for _ in range(300)]
    full = spark.createDataFrame([(k, bytearray(v.tobytes())) for k, v in enumerate(sets)], "rep bigint, shingles binary")
    reps = spark.createDataFrame([(k, 85, k) for k in range(300)], "rep bigint, n_shingles bigint, comp bigint")
    found = {(r.a, r.b) for r in minhash._prefix_candidates(reps, full, 80).collect()}
    both = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a in range(300) for b in range(a + 1, 300)}
    links = {pair for pair, n in both.items() if 100 * n >= 80 * (170 - n)}
    # Of 44,850 pairs; the bound is not exact, so some pairs close to the threshold remain.
    assert links <= found and len(found) <= 2 * len(links) + 100

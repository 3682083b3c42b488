import random
import re

import numpy as np
from pyspark.sql import functions as F

from visitlens.llm import near_dup, queries, shingles
from visitlens.llm.components import connected_components


def word_set(text, n):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def by_force(texts, n):
    """{doc_id: (size, component)} from {doc_id: text}."""
    sets = {i: word_set(t, n) for i, t in texts.items()}
    component = {i: i for i in texts}

    def find(i):
        while component[i] != i:
            i = component[i]
        return i

    ids = sorted(texts)
    for i in ids:
        for j in ids:
            a, b = sets[i], sets[j]
            if j < i and a and 100 * len(a & b) >= 80 * len(a | b):
                one, two = find(i), find(j)
                component[max(one, two)] = min(one, two)
    return {i: (len(sets[i]), find(i)) for i in texts}


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(7, 7)]
    frame = spark.createDataFrame([*edges, (1, None)], "a long, b long")
    got = {r.node: r.component for r in connected_components(frame).collect()}
    label = {n: n for e in edges for n in e}
    for _ in range(70):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert {n: c for n, c in label.items() if n != 7 or c != 7} == got
    assert connected_components(frame.where("a < 0")).count() == 0


def test_shingles_match_sets_of_words():
    for text in [None, "", " \t", "a", "A a", "one two three", "x y z w v u x y z w v",
                 "Ünï ÇODE words hëre", "a\x0bb\x0cc\rd e"]:
        for n in (1, 4, 5):
            assert len(shingles.shingles(text, n)) == len(word_set(text, n))
    assert (shingles.shingles("A B c d") == shingles.shingles("a  b C\nD")).all()
    assert (shingles.shingles("é b") != shingles.shingles("É b")).any()


def test_bands_miss_hardly_a_pair_at_the_threshold():
    """200,000 pairs at similarity 0.8: bands that share minima miss about 15."""
    rng = np.random.default_rng(11)
    missed = 0
    for _ in range(10):
        one, two = rng.integers(0, 2**32, (2, 20_000, near_dup.HASHES), dtype=np.uint32)
        two = np.where(rng.random(one.shape) < 0.8, one, two)
        met = near_dup.band_keys(one) == near_dup.band_keys(two)
        missed += int((~met.any(axis=1)).sum())
    assert missed <= 2


def test_against_all_pairs(spark, sf_docs):
    texts = {r.doc_id: r.text for r in sf_docs.collect()}
    want = by_force(texts, 4)
    for r in queries.op9_minhash(spark, "/root/testdata/sf0.001").collect():
        assert (r.n_shingles, r.component_id) == want[r.doc_id]
        assert r.kept == (r.component_id == r.doc_id)


def near_copies(n, words, seed):
    """Versions of one text with a few words changed each."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    for i in range(n):
        own = list(base)
        for _ in range(i % 6):
            own[rng.randrange(words)] = f"c{rng.randrange(10**6)}"
        yield " ".join(own)


def test_large_groups_of_copies(spark, documents):
    common = " ".join(f"p{i}" for i in range(40))
    rng = random.Random(5)
    texts = list(near_copies(150, 120, 1))
    texts += [texts[3]] * 40
    texts += [common + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(60))
              for _ in range(120)]
    texts += [None, "", "  ", "hi", "hi", "Hi there", "hi  there"]
    want = by_force(dict(enumerate(texts)), 5)
    docs = documents(*enumerate(texts)).withColumn("kept", F.lit("clash"))
    got = near_dup.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_blocks_of_a_large_bucket(spark, documents, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    texts = list(near_copies(60, 60, 2))
    want = by_force(dict(enumerate(texts)), 4)
    got = near_dup.near_duplicates(documents(*enumerate(texts)), words=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_null_ids_repeats_and_empty(spark, documents):
    text = "one two three four five six"
    docs = documents((None, text), (4, text), (4, text), (2, text), (7, "other words here"))
    rows = near_dup.near_duplicates(docs).collect()
    told = sorted(((r.doc_id, r.component_id, r.kept) for r in rows), key=repr)
    assert told == sorted(
        [(None, None, True), (4, 2, False), (4, 2, False), (2, 2, True), (7, 7, True)], key=repr
    )
    assert near_dup.near_duplicates(documents()).count() == 0

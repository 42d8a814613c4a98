"""op13: HyperMinHash near-duplicates against exact Jaccard over all pairs."""

import random

import numpy as np
import pytest

from plumbline.llm import hyperminhash as H

DOCS = "doc_id bigint, text string, n bigint, sid bigint, rep bigint, band int, key bigint, kept boolean"


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 2:
        return set(words)
    return set(zip(words, words[1:]))


def brute(rows):
    """Exact Jaccard over every pair, then the smallest id reachable."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            r = find(i)
            least[r] = min(least.get(r, doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        c = least.get(find(i))
        out.append((doc_id, len(sets[i]), c, doc_id == c))
    return sorted(out, key=repr)


def corpus(seed=7):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randint(30, 120))) for _ in range(12)]
    texts = []
    for b in base:
        texts.append(b)
        words = b.split()
        for k in range(rng.randint(1, 6)):  # near copies: a few words changed, chained
            w = list(words)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(" ".join(w))
            words = w
    texts += [base[0]] * 5  # exact copies
    texts += ["One", "one", "ONE two", "", None, " \t\n ", "x" * 50_000, ("a b " * 20_000).strip()]
    texts += [("long passage " * 3000) + tail for tail in ("end", "stop")]
    return [(i if i % 17 else None, t) for i, t in enumerate(texts)]


def test_components_equal_exact_jaccard_over_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5, True) for i, t in rows], DOCS)
    got = sorted((tuple(r) for r in H.near_duplicates(df).collect()), key=repr)
    assert got == brute(rows)


def test_repeated_rows_and_an_empty_table(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d e"), (None, None), (3, "")]
    df = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5, True) for i, t in rows], DOCS)
    got = sorted((tuple(r) for r in H.near_duplicates(df).collect()), key=repr)
    # {ab, bc, cd} and {ab, bc, cd, de}: 3 of 4, below 0.8; equal rows are one member.
    assert got == sorted([(1, 3, 1, True), (1, 3, 1, True), (2, 4, 2, True), (None, 0, None, True), (3, 0, 3, True)], key=repr)
    assert H.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_compressed_registers_agree_when_minhashes_do():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 500, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:450], rng.integers(0, 2**63, 50, dtype=np.uint64)]))
    ra, rb = H.registers(a), H.registers(b)
    exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    est = H.estimate((ra == rb).sum(), len(a), len(b))
    assert abs(est - exact) < 0.15
    assert H.collision_chance(1000, 1000) < 1e-3


def test_banding_recall_at_the_threshold():
    """Pairs at Jaccard 0.8 to 0.85 share a band and pass the estimate floor."""
    rng = np.random.default_rng(3)
    missed = 0
    for _ in range(300):
        n = int(rng.integers(20, 400))
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        keep = int(np.ceil(n * 0.8 / 1.0))
        extra = int(round(keep / 0.8)) - n
        b = np.concatenate([a[: n - extra], rng.integers(0, 2**63, extra, dtype=np.uint64)]) if extra > 0 else a.copy()
        a, b = np.unique(a), np.unique(b)
        ra, rb = H.registers(a), H.registers(b)
        same_band = (ra.view(np.int64) == rb.view(np.int64)).any()
        ok = H.estimate((ra == rb).sum(), len(a), len(b)) >= H.ESTIMATE_FLOOR
        missed += not (same_band and ok)
    assert missed == 0


def test_the_side_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(H, "BROADCAST_KEYS", 0)
    rows = corpus(9)
    df = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5, True) for i, t in rows], DOCS)
    assert sorted((tuple(r) for r in H.near_duplicates(df).collect()), key=repr) == brute(rows)

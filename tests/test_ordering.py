"""Orders, batches, packing and samples against brute force, for any layout of the rows."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import ordering, sampling

# Most rows share one length; keys are spread over the whole range of 64 bits
RND = random.Random(7)
KEYS = [RND.randrange(-(2**62), 2**62) for _ in range(150)] + [0, 1, 2, 2**21 - 1, 2**21, 2**21 + 1, 2**42, -1, -(2**42), 2**63 - 1]
ROWS = [(k, RND.choice([5, 5, 5, 5, 0, 3, 90, 700]), RND.choice("xy")) for k in KEYS]


@pytest.fixture(params=[1, 40])
def table(spark, request):
    df = spark.createDataFrame(ROWS, "ord bigint, n_tokens int, shard string")
    return df.repartition(request.param)


def test_rank(table):
    got = {r.ord: r.rank for r in ordering.length_sorted_order(table).collect()}
    want = sorted(ROWS, key=lambda r: (-r[1], r[0]))
    assert got == {r[0]: i for i, r in enumerate(want, 1)}


def test_restored_order(table):
    rows = ordering.restore_order(ordering.length_sorted_order(table)).collect()
    assert [r.ord for r in rows] == sorted(KEYS)


def test_batches(table):
    got = ordering.length_sorted_batches(table, batch_size=7).collect()
    want = sorted(ROWS, key=lambda r: (-r[1], r[0]))
    expected = {}
    for b in range(0, len(want), 7):
        longest = max(r[1] for r in want[b : b + 7])
        for r in want[b : b + 7]:
            expected[r[0]] = (b // 7, math.ceil(longest / 8) * 8, math.ceil(longest / 8) * 8 - r[1])
    assert {r.ord: (r.batch_id, r.padded_len, r.waste) for r in got} == expected


def packed(rows, block):
    """Token by token."""
    out, at = {}, 0
    for key, n, _ in sorted(rows):
        for i in range(n):
            lo, hi = out.get((at // block, key), (i, i))
            out[(at // block, key)] = (min(lo, i), max(hi, i + 1))
            at += 1
    return out


@pytest.mark.parametrize("shard", [None, "shard"])
def test_packing(table, shard):
    rows = ordering.pack_sequences(table, 64, shard=shard).collect()
    got = {(r["shard"] if shard else None, r.block_id, r.ord): (r["from"], r["to"]) for r in rows}
    want = {}
    for name in ("x", "y") if shard else (None,):
        part = [r for r in ROWS if name in (None, r[2])]
        want |= {(name, b, k): v for (b, k), v in packed(part, 64).items()}
    assert got == want
    assert len(rows) == len(got)


def test_null_key_fails(spark):
    df = spark.createDataFrame([(None, 1)], "ord bigint, n_tokens int")
    with pytest.raises(Exception, match="ord is null"):
        ordering.length_sorted_order(df).collect()
    with pytest.raises(TypeError):
        ordering.length_sorted_order(df.withColumn("ord", F.lit("a")))


IDS = [f"r{i}" for i in range(500)]


def seeded(ids, seed=42):
    return sorted(ids, key=lambda i: (int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:15], 16), i))


@pytest.fixture(params=[1, 16])
def ids(spark, request):
    return spark.createDataFrame([(i,) for i in IDS], "pair_id string").repartition(request.param)


@pytest.mark.parametrize("n", [0, 1, 77, 500, 9999])
def test_sample_is_exact(ids, n):
    got = {r.pair_id for r in sampling.sample_n(ids, n).collect()}
    assert got == set(seeded(IDS)[:n])


@pytest.mark.parametrize("n, size", [(1, 10), (40, 48), (1000, 100)])
def test_split_sizes(ids, n, size):
    rows = sampling.train_test_split(ids, n).collect()
    test = {r.pair_id for r in rows if r.part == "test"}
    assert len(rows) == 500 and test == set(seeded(IDS)[:size])


def test_other_seed_other_sample(ids):
    first = {r.pair_id for r in sampling.sample_n(ids, 50, seed=1).collect()}
    assert first == set(seeded(IDS, 1)[:50]) != set(seeded(IDS)[:50])


def test_empty_table(spark):
    none = spark.createDataFrame([], "pair_id string")
    assert sampling.sample_n(none, 5).count() == 0
    assert sampling.train_test_split(none, 5).count() == 0

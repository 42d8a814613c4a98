"""MinHash near-duplicates with HyperMinHash registers: banding, estimate, exact Jaccard, components.

A document's set is its distinct 2-word shingles (lower-cased A-Z, words
between white space); one word is a set of one, no word an empty set. Each
shingle is a 64-bit hash (a pair of word hashes mixed, so two different word
pairs share it only by a 64-bit collision). A sketch holds ``REGISTERS``
min-hashes, each compressed HyperMinHash-wise to the count of leading zeros
(6 bits) and the ``MANTISSA`` bits after the leading one: 16 bits. Four
registers make one 64-bit band key, so the bands are plain long columns.

Compression only merges values, never splits them: two sets whose min-hashes
agree also agree on the compressed register, so banding on compressed
registers loses no candidate that plain MinHash banding would find; it only adds
false ones. Those are thinned by the collision-corrected Jaccard estimate and
then decided exactly on the full shingle sets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.common import as_bytes, stored
from plumbline.llm.components import components
from plumbline.llm.links import bucket_links
from plumbline.operators.scale import lookup_join

#: Fixed values of the contract: words per shingle, a link at 100 * |A ∩ B| >= 80 * |A ∪ B|.
SHINGLE, NUMERATOR, DENOMINATOR = 2, 80, 100
#: Registers of a sketch, registers per band, mantissa bits of a register.
REGISTERS, ROWS, MANTISSA = 128, 4, 10
BANDS = REGISTERS // ROWS
#: Candidates whose corrected estimate is below this are not verified. At a true
#: Jaccard of 0.8 the estimate of 128 registers has a deviation of 0.035, so
#: this lies seven deviations below.
ESTIMATE_FLOOR = 0.55
#: Texts wanted for the exact check are picked by a broadcast of their keys up to
#: this many keys (about 24 bytes each); beyond it, by a shuffled semi-join.
BROADCAST_KEYS = 2_000_000
_NO_ID = -(2**63)

_SEEDS = np.random.default_rng(20240613).integers(0, 2**63, size=(2, REGISTERS), dtype=np.uint64)
_MULTIPLY = _SEEDS[0] * np.uint64(2) + np.uint64(1)  # odd: each register is a bijection of the hash
_ADD = _SEEDS[1]
_ONE_WORD = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 4096


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A 64-bit hash of an ordered pair of 64-bit hashes (splitmix64 finaliser over a combination)."""
    with np.errstate(over="ignore"):
        z = left * np.uint64(0xBF58476D1CE4E5B9) + ((right << np.uint64(31)) | (right >> np.uint64(33)))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct shingle hashes (uint64) of one UTF-8 text."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    if len(words) < SHINGLE:
        return _mix(h, np.full(1, _ONE_WORD))
    return np.unique(_mix(h[:-1], h[1:]))


def _bit_length(u: np.ndarray) -> np.ndarray:
    n = np.zeros(u.shape, np.int64)
    x = u.copy()
    for s in (32, 16, 8, 4, 2, 1):
        big = x >= (np.uint64(1) << np.uint64(s))
        n[big] += s
        x[big] >>= np.uint64(s)
    return n + (x > 0)


def registers(shingles: np.ndarray) -> np.ndarray:
    """``REGISTERS`` compressed min-hashes (uint16) of a non-empty set."""
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for start in range(0, len(shingles), _CHUNK):
            part = shingles[start : start + _CHUNK, None]
            np.minimum(low, (part * _MULTIPLY + _ADD).min(axis=0), out=low)
    length = _bit_length(low)
    zeros = 64 - length
    # The MANTISSA bits after the leading one (zeros shifted in when there are fewer).
    after = length - 1
    right = np.maximum(after - MANTISSA, 0).astype(np.uint64)
    left = np.maximum(MANTISSA - after, 0).astype(np.uint64)
    mantissa = ((low >> right) << left) & np.uint64((1 << MANTISSA) - 1)
    return ((np.minimum(zeros, 63).astype(np.uint64) << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)


def collision_chance(n: np.ndarray | int, m: np.ndarray | int) -> np.ndarray:
    """Chance that the registers of two unrelated sets of n and m members agree by accident.

    The minimum of n uniform values has density about n e^(-nx); a register cell at x
    is about ln 2 * x / 2^MANTISSA wide, so the chance is ln 2 * n m / (n + m)^2 / 2^MANTISSA.
    """
    n, m = np.asarray(n, np.float64), np.asarray(m, np.float64)
    return math.log(2) * n * m / np.maximum((n + m) ** 2, 1) / (1 << MANTISSA)


def estimate(matches: np.ndarray, n: np.ndarray | int, m: np.ndarray | int) -> np.ndarray:
    """Collision-corrected Jaccard estimate from the count of equal registers."""
    chance = collision_chance(n, m)
    return np.maximum(0.0, (matches / REGISTERS - chance) / (1 - chance))


def linked(inter: int, n: int, m: int) -> bool:
    return DENOMINATOR * inter >= NUMERATOR * (n + m - inter)


def _sets(batches):
    """``k_doc, t1, t2, shingles``: the set of each text as packed uint64."""
    for batch in batches:
        sets = [shingle_set(t).tobytes() for t in as_bytes(batch.column(batch.schema.get_field_index("text")))]
        keep = [batch.column(batch.schema.get_field_index(c)) for c in ("k_doc", "t1", "t2")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(sets, pa.binary())], names=["k_doc", "t1", "t2", "shingles"])


def _sketches(batches):
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text"))
        sizes, first, second, bands = [], [], [], [[] for _ in range(BANDS)]
        for text in as_bytes(texts):
            s = shingle_set(text)
            sizes.append(len(s))
            raw = s.tobytes()
            first.append(xxhash.xxh64_intdigest(raw, 1) - (1 << 63) if len(s) else 0)
            second.append(xxhash.xxh64_intdigest(raw, 2) - (1 << 63) if len(s) else 0)
            packed = registers(s).view(np.int64) if len(s) else np.zeros(BANDS, np.int64)
            for j in range(BANDS):
                bands[j].append(int(packed[j]))
        arrays = [
            batch.column(batch.schema.get_field_index("doc_id")),
            batch.column(batch.schema.get_field_index("t1")),
            batch.column(batch.schema.get_field_index("t2")),
            pa.array(sizes, pa.int64()),
            pa.array(first, pa.int64()),
            pa.array(second, pa.int64()),
            *(pa.array(b, pa.int64()) for b in bands),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=_SKETCH)


_BAND_NAMES = [f"b{j}" for j in range(BANDS)]
_SKETCH = ["doc_id", "t1", "t2", "n", "h1", "h2", *_BAND_NAMES]


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with ``t1, t2``: two 64-bit hashes of the text, which with the id find a row's text again."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"),
        F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("t2"), text).alias("t2"),
    )


def sketch(docs: DataFrame) -> DataFrame:
    """``doc_id, t1, t2, n, h1, h2, b0..`` for every row: text keys, set size, set digest, band keys."""
    schema = "doc_id bigint, t1 bigint, t2 bigint, n bigint, h1 bigint, h2 bigint, " + ", ".join(
        f"{b} bigint" for b in _BAND_NAMES
    )
    return _keyed(docs).mapInArrow(_sketches, schema)


def _near(cell):
    n = np.asarray(cell["n"], np.int64)
    regs = np.stack([np.asarray(cell[b], np.int64) for b in _BAND_NAMES], axis=1).view(np.uint16)
    raw = cell["shingles"]
    sets: dict[int, np.ndarray] = {}

    def members(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = np.frombuffer(raw[i], np.uint64)
        return sets[i]

    def test(i: int, others: np.ndarray) -> np.ndarray:
        small, large = np.minimum(n[others], n[i]), np.maximum(n[others], n[i])
        hit = DENOMINATOR * small >= NUMERATOR * large  # |A ∩ B| / |A ∪ B| <= min / max
        maybe = np.flatnonzero(hit)
        matches = (regs[others[maybe]] == regs[i]).sum(axis=1)
        close = estimate(matches, n[i], n[others[maybe]]) >= ESTIMATE_FLOOR
        hit[maybe[~close]] = False
        for k in maybe[close]:
            j = int(others[k])
            inter = np.intersect1d(members(i), members(j), assume_unique=True).size
            hit[k] = linked(inter, int(n[i]), int(n[j]))
        return hit

    return test


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs (doc_id, text)``.

    Other columns are not read, whatever their names. Null and empty texts and
    texts without words have the empty set: linked with nothing, their own
    component. Rows with the same set are one member, whatever their number, so
    groups of copies cost one sketch comparison. ``component_id`` is the
    smallest doc_id reachable (nulls are passed over; null if the component has
    no id); ``kept`` is ``doc_id <=> component_id``, so every row that carries
    the component's id is kept, and a row without id only when its component
    has none. An empty table gives no rows.
    """
    sketches = stored(sketch(docs), "sketches")
    first = [F.first(b).alias(b) for b in _BAND_NAMES]
    k_doc = F.coalesce("doc_id", F.lit(_NO_ID))
    distinct = sketches.where("n > 0").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("least"), F.min(F.struct(k_doc.alias("k_doc"), "t1", "t2")).alias("rep"),
        F.first("n").alias("n"), *first,
    )
    distinct = stored(distinct.withColumn("sid", F.monotonically_increasing_id()), "distinct_sets")

    band_keys = F.array(*(F.struct(F.lit(j).alias("band"), F.col(b).alias("key")) for j, b in enumerate(_BAND_NAMES)))
    members = distinct.select("sid", "n", *_BAND_NAMES, F.explode(band_keys).alias("k")).select(
        "k.band", "k.key", "sid", "n", *_BAND_NAMES
    )
    keys = ["k_doc", "t1", "t2"]

    def fetch(placed: DataFrame) -> DataFrame:
        """The members of cells with their sets, rebuilt from the texts of those members only."""
        payload = distinct.select(F.col("sid").alias("_member"), "rep.*", "n", *_BAND_NAMES)
        reps = lookup_join(placed, payload, ["_member"])
        needed = stored(reps.select(*keys).distinct(), "wanted_texts")
        pick = F.broadcast(needed) if needed.count() <= BROADCAST_KEYS else needed
        texts = (
            _keyed(docs).withColumn("k_doc", F.coalesce("doc_id", F.lit(_NO_ID)))
            .join(pick, keys, "left_semi")
            .dropDuplicates(keys)
        )
        sets = texts.select(*keys, "text").mapInArrow(_sets, "k_doc bigint, t1 bigint, t2 bigint, shingles binary")
        return reps.join(sets, keys).drop(*keys)

    links = bucket_links(members, ["band", "key"], "sid", ["n", *_BAND_NAMES, "shingles"], _near, fetch=fetch)
    found = components(links)
    least = distinct.select(F.col("sid").alias("node"), "least")
    roots = found.join(least, "node").groupBy("root").agg(F.min("least").alias("component_id"))
    classes = lookup_join(found, roots, ["root"]).select(F.col("node").alias("sid"), "component_id")
    classes = distinct.select("h1", "h2", "sid", "least").join(classes, "sid", "left").select(
        "h1", "h2", F.coalesce("component_id", "least").alias("component_id")
    )
    rows = sketches.select("doc_id", "n", "h1", "h2")
    out = lookup_join(rows.where("n > 0"), classes, ["h1", "h2"]).select("doc_id", "n", "component_id")
    out = out.unionByName(rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )

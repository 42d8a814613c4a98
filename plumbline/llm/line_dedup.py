"""Fuzzy line dedup: MinHash of character shingles, banding, exact Jaccard, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import as_bytes, slices, stored
from plumbline.llm.components import components
from plumbline.llm.links import bucket_links
from plumbline.operators.scale import lookup_join

#: Characters per shingle, similarity of a link.
SHINGLE, SIMILAR = 8, 0.8
#: Signature slots are taken in bands of so many rows: two lines of similarity
#: 0.8 share one of the eight bands with a chance of 0.985, of 0.9 with 0.9998.
BANDS, ROWS = 8, 4
#: Candidate lines whose keys are broadcast; beyond it their texts come by a shuffle.
BROADCAST_KEYS = 1_000_000

_SEED = 42  # of Spark's own xxhash64
_SECOND = 7
_SLOT_BITS = 5
_TOP = np.uint64((1 << 64) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_GROUP = 1 << 19
#: Lines of like size up to which each is compared by itself.
_FEW = 8
_FAR = np.arange(1 << _SLOT_BITS, dtype=np.uint64) * _ODD


def plain(line: str) -> str:
    """What shingles are taken from: lower case, white space as single spaces."""
    return " ".join(line.lower().split())


def shingles(line: str) -> frozenset[str]:
    """Character shingles; a shorter line is one shingle."""
    text = plain(line)
    return frozenset(text[i : i + SHINGLE] for i in range(max(1, len(text) - SHINGLE + 1)))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _least(texts: list[str]) -> np.ndarray:
    """(texts, slots): the least hash of a shingle in each slot; an empty slot has ``_TOP``."""
    sizes = np.array(list(map(len, texts)))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    # Shingles of twice the characters from two, as one polynomial of the characters.
    rolled, factor, span = codes, int(_ODD), 1
    while span < SHINGLE:
        rolled = rolled[:-span] * np.uint64(factor) + rolled[span:]
        factor, span = factor * factor % (1 << 64), 2 * span
    h = _mixed(rolled)
    # What begins in one line and ends in the next is no shingle.
    over = (np.cumsum(sizes)[:-1, None] - np.arange(1, SHINGLE)).ravel()
    h[over] = _TOP
    slots = 1 << _SLOT_BITS
    place = np.repeat(np.arange(len(texts)) * slots, sizes)[: len(h)]
    place += (h >> np.uint64(64 - _SLOT_BITS)).view(np.int64)
    least = np.full(len(texts) * slots, _TOP)
    np.minimum.at(least, place, h)
    return least.reshape(-1, slots)


def bands(lines: list[str]) -> np.ndarray:
    """(lines, BANDS) keys. One hash of each shingle fills one of 32 slots; empty slots borrow from the next."""
    texts = [plain(line).ljust(SHINGLE, "\0") for line in lines]
    # As many lines at a time as a core's cache has room for.
    cuts = np.flatnonzero(np.diff(np.cumsum(list(map(len, texts))) >> 15)) + 1
    cuts = [0, *cuts.tolist(), len(texts)]
    least = np.concatenate([_least(texts[i:j]) for i, j in zip(cuts, cuts[1:])])
    slots = 1 << _SLOT_BITS
    filled = least.copy()
    empty = least == _TOP
    for step in range(1, slots):
        if not empty.any():
            break
        near = np.roll(least, -step, axis=1)
        use = empty & (near != _TOP)
        filled[use] = near[use] + _FAR[step]
        empty &= ~use
    rows = filled.reshape(-1, BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for r in range(ROWS):
        key = _mixed(key * _ODD + rows[:, :, r])
    return key.view(np.int64)


_LINES = "rid bigint, doc_id bigint, line_no int, n_lines int, h bigint, h2 bigint, " + ", ".join(
    f"b{k} bigint" for k in range(BANDS)
)


def _lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per line with a word, and one of number -1 per document."""
    names = [part.split()[0] for part in _LINES.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * (2 + BANDS)]

    def answer(rows, texts) -> pa.RecordBatch:
        keys = bands(texts) if texts else np.zeros((0, BANDS), np.int64)
        real = np.array([r[2] >= 0 for r in rows], bool)
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        for k in range(BANDS):
            own = np.zeros(len(rows), np.int64)
            own[real] = keys[:, k]
            columns.append(pa.array(own, mask=~real))
        return pa.RecordBatch.from_arrays(columns, names=names)

    rows, texts, size = [], [], 0
    for batch in (s for b in batches for s in slices(b, 2)):
        for rid, doc_id, text in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2))
        ):
            lines = text.split(b"\n")
            rows.append((rid, doc_id, -1, len(lines), None, None))
            for i, line in enumerate(lines):
                if line.strip():
                    h, h2 = xxhash.xxh64_intdigest(line, _SEED), xxhash.xxh64_intdigest(line, _SECOND)
                    rows.append((rid, doc_id, i, len(lines), h - (h >> 63 << 64), h2 - (h2 >> 63 << 64)))
                    texts.append(line.decode())
                    size += len(line)
                    if size > _GROUP:
                        yield answer(rows, texts)
                        rows, texts, size = [], [], 0
    if rows:
        yield answer(rows, texts)


def _near_any(lines: list[str]):
    known: dict[int, frozenset[str]] = {}

    def of(i: int) -> frozenset[str]:
        if i not in known:
            known[i] = shingles(lines[i])
        return known[i]

    def near(i: int, others: np.ndarray) -> np.ndarray:
        own, hits = of(i), []
        for j in others.tolist():
            other = of(j)
            small, large = sorted((len(own), len(other)))
            both = len(own & other) if small >= SIMILAR * large else 0
            hits.append(both >= SIMILAR * (small + large - both))
        return np.array(hits, bool)

    return near


def _near_latin(texts: list[str]):
    """As ``_near_any`` for plain Latin-1 lines without NUL: eight characters are the eight bytes of one number."""
    raw = [text.ljust(SHINGLE, "\0").encode("latin-1") for text in texts]
    whole = b"".join(raw)
    window = np.ndarray((len(whole) - SHINGLE + 1,), np.uint64, whole, strides=(1,))
    sets, start = [], 0
    for text in raw:
        numbers = np.sort(window[start : start + len(text) - SHINGLE + 1])
        start += len(text)
        new = numbers[1:] != numbers[:-1]
        sets.append(numbers if new.all() else numbers[np.concatenate(([True], new))])
    sizes = np.array(list(map(len, sets)))

    def near(i: int, others: np.ndarray) -> np.ndarray:
        own, size = sets[i], sizes[others]
        hits = np.minimum(len(own), size) >= SIMILAR * np.maximum(len(own), size)
        at = hits.nonzero()[0]
        if len(at) <= _FEW:
            for k in at.tolist():
                # Two sets after each other: what both hold stands twice once sorted.
                theirs = sets[others[k]]
                pair = np.concatenate((own, theirs))
                pair.sort(kind="stable")
                both = np.count_nonzero(pair[1:] == pair[:-1])
                hits[k] = both >= SIMILAR * (len(own) + len(theirs) - both)
            return hits
        # A few hundred thousand shingles of the others at a time.
        upto = np.cumsum(size[at])
        for part in np.split(at, np.flatnonzero(np.diff(upto >> 18)) + 1):
            theirs = np.concatenate([sets[j] for j in others[part].tolist()])
            same = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
            both = np.add.reduceat(same, np.cumsum(size[part]) - size[part], dtype=np.int64)
            hits[part] = both >= SIMILAR * (len(own) + size[part] - both)
        return hits

    return near


def _near(cell):
    texts = [plain(line) for line in cell["line"]]
    try:
        return _near_any(cell["line"]) if any("\0" in text for text in texts) else _near_latin(texts)
    except UnicodeEncodeError:
        return _near_any(cell["line"])


def line_classes(docs: DataFrame) -> DataFrame:
    """Every line with a word of ``docs (rid, doc_id, text)``, and whether it is kept.

    Columns: rid, doc_id, line_no (from 0), n_lines, kept; a document's row of
    number -1 carries its count. Lines are one class if links of similarity 0.8
    connect them; the first by document id, row and place is kept, all others
    are not. Equal lines collapse first, by partial aggregation over a 64-bit
    key; should two different lines share a key, a second hash shows it and all
    lines of the key are kept.
    """
    lines = stored(docs.select("rid", F.col("doc_id").cast("bigint"), "text").mapInArrow(_lines_of, _LINES), "lines")
    keyed = [f"b{k}" for k in range(BANDS)]
    distinct = stored(
        lines.where("h is not null")
        .groupBy("h")
        .agg(F.min("h2").alias("lo"), F.max("h2").alias("hi"), *(F.min(b).alias(b) for b in keyed))
        .select("h", (F.col("lo") == F.col("hi")).alias("sound"), *keyed),
        "distinct-lines",
    )
    members = distinct.where("sound").select("h", F.posexplode(F.array(*keyed)).alias("band", "key"))

    def texts(placed: DataFrame) -> DataFrame:
        placed = stored(placed, "candidates")
        wanted = placed.select(F.col("_member").alias("h")).distinct()
        if wanted.count() <= BROADCAST_KEYS:
            wanted = F.broadcast(wanted)
        found = (
            docs.select(F.explode(F.split("text", "\n")).alias("line"))
            .where(F.col("line").rlike("[^\\x20\\x09-\\x0D]"))
            .select(F.xxhash64("line").alias("h"), "line")
            .join(wanted, "h", "left_semi")
            .groupBy("h")
            .agg(F.min("line").alias("line"))
        )
        return placed.join(found.withColumnRenamed("h", "_member"), "_member")

    links = bucket_links(members, ["band", "key"], "h", ["line"], _near, fetch=texts)
    roots = components(links).select(F.col("node").alias("h"), "root")
    # A key that hides two lines is a class for each of its lines.
    sound = lookup_join(lines.drop(*keyed), distinct.select("h", "sound"), ["h"], "left")
    classed = lookup_join(sound, roots, ["h"], "left").withColumn(
        "class", F.when(F.col("sound"), F.coalesce("root", "h"))
    )
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "rid", "line_no")
    first = classed.where("class is not null").groupBy("class").agg(F.min(place).alias("first"))
    kept = F.col("first").isNull() | ((F.col("first.rid") == F.col("rid")) & (F.col("first.line_no") == F.col("line_no")))
    return lookup_join(classed, first, ["class"], "left").select(
        "rid", "doc_id", "line_no", "n_lines", kept.alias("kept")
    )


def report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs (doc_id, text)``: lines, lines removed, and their numbers in order.

    Lines without a word are never removed. Null and empty texts have one empty
    line; an empty table gives an empty result; rows with equal ids each have a
    row.
    """
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("rid"))
    gone = F.col("line_no").cast("int")
    return (
        line_classes(rows)
        .groupBy("rid", "doc_id")
        .agg(
            F.max("n_lines").cast("bigint").alias("n_lines"),
            F.count(F.when(~F.col("kept"), 1)).alias("n_removed"),
            F.array_sort(F.collect_list(F.when(~F.col("kept"), gone))).alias("removed"),
        )
        .drop("rid")
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that are not kept taken out of the texts, columns unchanged."""
    rid = "_rid_of_lines"
    rows = stored(docs.withColumn(rid, F.monotonically_increasing_id()), "rows")
    gone = (
        line_classes(rows.select("doc_id", "text", F.col(rid).alias("rid")))
        .where(~F.col("kept"))
        .groupBy(F.col("rid").alias(rid))
        .agg(F.collect_set("line_no").alias("_gone_lines"))
    )
    left = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains("_gone_lines", i))
    text = F.when(F.col("_gone_lines").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return rows.join(gone, rid, "left").withColumn("text", text).select(*docs.columns)

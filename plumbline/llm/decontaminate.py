"""Benchmark decontamination: a broadcast hash set of test n-grams scans every training window."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.common import ALNUM, as_bytes, digest

#: Fixed values of the contamination rule.
WINDOW, SHARE = 13, 20
#: Benchmark text per broadcast; a larger benchmark is scanned in several blocks of this size.
BLOCK_BYTES = 16 << 20

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters, digits and non-ASCII characters."""
    return text.translate(ALNUM).split()


@dataclass(frozen=True)
class Grams:
    """The n-grams of one block of items, by length."""

    vocabulary: dict[bytes, int]  # words are numbered from 1
    hashes: dict[int, np.ndarray]  # length: sorted rolling hashes, the cheap test
    items: dict[bytes, list[int]]  # word numbers of a window: its items, the exact test


def _rolling(ids: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        total = total * _ODD + ids[at + k].astype(np.uint64)
    return total


def index(items: Iterable[tuple[int | None, bytes]], window: int = WINDOW) -> Grams:
    vocabulary: dict[bytes, int] = {}
    owners: dict[bytes, list[int]] = {}
    by_size: dict[int, list[int]] = {}
    for item, text in items:
        ids = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text)], np.int32)
        if not len(ids):
            continue
        size = min(window, len(ids))
        at = np.arange(len(ids) - size + 1)
        by_size.setdefault(size, []).append(_rolling(ids, at, size))
        for i in at:
            named = owners.setdefault(ids[i : i + size].tobytes(), [])
            if item is not None and item not in named:
                named.append(item)
    hashes = {size: np.unique(np.concatenate(h)) for size, h in by_size.items()}
    return Grams(vocabulary, hashes, owners)


def scan(grams: Grams, found: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
    """Word ranges hit in one document, and the items whose windows hit them."""
    n = len(found)
    ids = np.fromiter(map(grams.vocabulary.get, found, repeat(0)), np.int32, n)
    # How many words from here on are known to the benchmark.
    unknown = np.flatnonzero(ids == 0)
    after = np.append(unknown, n)[np.searchsorted(unknown, np.arange(n))] - np.arange(n)
    spans: list[tuple[int, int]] = []
    items: set[int] = set()
    for size, hashes in grams.hashes.items():
        at = np.flatnonzero(after >= size)
        if not len(at):
            continue
        rolled = _rolling(ids, at, size)
        place = np.minimum(np.searchsorted(hashes, rolled), len(hashes) - 1)
        for i in at[hashes[place] == rolled].tolist():
            owners = grams.items.get(ids[i : i + size].tobytes())
            if owners is not None:
                items.update(owners)
                spans.append((i, i + size))
    return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    joined: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return joined


_FOUND = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ("items", pa.list_(pa.int64())),
    ]
)


def _scanner(shared):
    def run(texts: pa.Array) -> pa.Array:
        grams, rows = shared.value, []
        for text in as_bytes(texts):
            found = words(text)
            spans, items = scan(grams, found)
            rows.append(
                {
                    "n_words": len(found),
                    "spans": [{"start": a, "end": b} for a, b in spans],
                    "items": sorted(items),
                }
            )
        return pa.array(rows, _FOUND)

    return F.arrow_udf(run, "n_words bigint, spans array<struct<start:int,end:int>>, items array<bigint>")


def _blocks(benchmark: DataFrame, block_bytes: int, window: int):
    """Broadcast indexes, each over a bounded share of the benchmark."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for b in range(blocks):
        part = rows if blocks == 1 else rows.where(number == b)
        yield spark.sparkContext.broadcast(index(((r[0], r[1].encode()) for r in part.toLocalIterator()), window))


def scanned(
    docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, window: int = WINDOW
) -> DataFrame:
    """All columns of ``docs`` and a record ``contamination``: n_words, spans, items.

    The benchmark is broadcast in blocks of at most about ``block_bytes`` of
    text (one long item more), each made into a hash set; documents never move.
    Hits of several blocks are put together per row. An item shorter than the
    window is one window of its own; one without words, or a null text, has
    none. A null item id still marks its words, but is not listed. A null or
    empty document has no words. A column ``contamination`` is replaced.
    """
    columns = [c for c in docs.columns if c != "contamination"]
    found = [_scanner(b)("text") for b in _blocks(benchmark, block_bytes, window)]
    if len(found) == 1:
        return docs.select(*columns, found[0].alias("contamination"))
    each = docs.select(*columns, F.array(*found).alias("contamination"))
    every = F.col("contamination")
    spans = F.array_sort(F.flatten(F.transform(every, lambda x: x["spans"])))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform(every, lambda x: x["items"]))))
    return each.withColumn(
        "contamination",
        F.struct(every[0]["n_words"].alias("n_words"), _joined(spans).alias("spans"), items.alias("items")),
    )


def _joined(spans: Column) -> Column:
    """Sorted ranges with overlapping and touching ones put together."""

    def step(done, s):
        last = F.element_at(done, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(
            (F.size(done) > 0) & (s["start"] <= F.try_element_at(done, F.lit(-1))["end"]),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(grown)),
        ).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(spans, F.array().cast("array<struct<start:int,end:int>>"), step)


def n_hit() -> Column:
    spans = F.col("contamination.spans")
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def contaminated() -> Column:
    return (n_hit() > 0) & (SHARE * n_hit() >= F.col("contamination.n_words"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: counts of words and hits, the items found, the verdict."""
    items = F.col("contamination.items")
    names = F.array_sort(F.transform(items, lambda i: i.cast("string")))
    return scanned(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        F.col("contamination.n_words").alias("n_words"),
        n_hit().alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        digest(F.array_join(names, ",")).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, columns unchanged."""
    return scanned(docs, benchmark).where(~contaminated()).select(*docs.columns)


def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    kept = []
    for text, ranges in zip(as_bytes(texts), spans.to_pylist()):
        if ranges:
            places = [m.span() for m in _WORD.finditer(text.translate(ALNUM))]
            pieces, last = [], 0
            for r in ranges:
                pieces.append(text[last : places[r["start"]][0]])
                last = places[r["end"] - 1][1]
            text = b"".join([*pieces, text[last:]])
        kept.append(text.decode())
    return pa.array(kept, pa.string())


def cut_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with the words that were hit cut out of the texts; the rest stays as it is."""
    cut = F.arrow_udf(_cut, "string")("text", F.col("contamination.spans"))
    text = F.when(F.size("contamination.spans") > 0, cut).otherwise(F.col("text"))
    return scanned(docs, benchmark).withColumn("text", text).select(*docs.columns)

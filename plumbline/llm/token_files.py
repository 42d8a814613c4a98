"""Token-ID output: Re-Pair compressed blocks in the order of ids, readable document by document."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from plumbline.llm.common import as_bytes
from plumbline.llm.repair import Expander, compress
from plumbline.llm.word_tokens import encoder
from plumbline.operators.scale import lookup_join

#: Fixed value: the id that ends a document.
END = 2
#: A block is closed by the document that brings it to so many ids.
BLOCK_IDS = 1 << 20
#: Text that is tokenized at once.
_GROUP_BYTES = 1 << 23

_BLOCK = pa.schema(
    [
        ("part", pa.int64()),
        ("block", pa.int64()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_symbols", pa.binary()),
        ("rules", pa.binary()),
        ("lengths", pa.binary()),
        ("symbols", pa.binary()),
    ]
)
_BLOCK_DDL = (
    "part bigint, block bigint, n_tokens bigint, doc_ids array<bigint>, doc_symbols binary, "
    "rules binary, lengths binary, symbols binary"
)


def _encoded(spec: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
    """Id and token bytes of each document, a bounded amount of text at a time."""
    tokens = encoder(spec)
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), as_bytes(batch.column(1))):
            ids.append(doc_id.as_py())
            texts.append(text)
            size += len(text)
            if size >= _GROUP_BYTES or len(texts) >= 4096:
                yield from zip(ids, tokens.encode(texts))
                ids, texts, size = [], [], 0
    if texts:
        yield from zip(ids, tokens.encode(texts))


def _blocks(spec: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    part, block = context.partitionId() if context else 0, 0
    end = np.array([END], np.uint16).tobytes()
    ids, pieces, counts, size = [], [], [], 0

    def closed() -> pa.RecordBatch:
        found = compress(np.frombuffer(b"".join(pieces), np.uint16), np.array(counts, np.int64))
        row = {
            "part": part,
            "block": block,
            "n_tokens": size,
            "doc_ids": ids,
            "doc_symbols": found.counts.astype("<u4").tobytes(),
            "rules": found.rules.astype("<u2").tobytes(),
            "lengths": found.lengths.astype("<u4").tobytes(),
            "symbols": found.symbols.astype("<u2").tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], schema=_BLOCK)

    for doc_id, tokens in _encoded(spec, batches):
        ids.append(doc_id)
        pieces += (tokens, end)
        counts.append(len(tokens) // 2 + 1)
        size += counts[-1]
        if size >= BLOCK_IDS:
            yield closed()
            block += 1
            ids, pieces, counts, size = [], [], [], 0
    if ids:
        yield closed()


def write_tokens(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Write the ids of every row of ``docs (doc_id, text)``, in ascending order of ids.

    Texts are shuffled once, by ranges of the id (and of the content, so that
    one id on many rows is no single range), and encoded and compressed where
    they arrive. Rows are blocks: ids of documents, symbols per document, rules
    with expansion lengths, symbols; all numbers little-endian. No pair crosses
    a document, so each can be decoded from its own symbols. A null text is
    empty and a null id comes first; every row has its end id. An empty table
    writes no block. Spark commits whole files, so a lost task is written anew.
    """
    spec = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text())
    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    ordered.mapInArrow(lambda batches: _blocks(spec.value, batches), _BLOCK_DDL).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            rules = np.frombuffer(row["rules"], "<u2").reshape(-1, 2)
            expand = Expander(rules, np.frombuffer(row["lengths"], "<u4"))
            symbols = np.frombuffer(row["symbols"], "<u2")
            ends = np.cumsum(np.frombuffer(row["doc_symbols"], "<u4"))
            upto = np.append(0, np.cumsum(expand.length[symbols]))
            ids = expand(symbols).astype("<u4")
            stops = upto[ends]
            starts = np.append(0, stops[:-1])
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), stops.tolist())]
            n = len(ends)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(np.full(n, row["part"])),
                    pa.array(np.full(n, row["block"])),
                    pa.array(starts),
                    pa.array(stops - starts),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "part", "block", "inner", "n_tokens", "ids_crc32"],
            )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files.

    ``start`` counts the ids of all documents before: those of earlier parts,
    of earlier blocks of the part and of earlier documents of the block. Only
    the counts of the blocks are read for it, and one row per part is windowed
    in one task.
    """
    files = spark.read.schema(_BLOCK_DDL).parquet(path)
    counts = files.select("part", "block", "n_tokens")
    before = Window.unboundedPreceding, -1
    parts = counts.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part",
        F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(*before)), F.lit(0)).alias("outer"),
    )
    blocks = counts.select(
        "part",
        "block",
        F.coalesce(
            F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block").rowsBetween(*before)), F.lit(0)
        ).alias("middle"),
    ).join(parts, "part")
    docs = files.mapInArrow(
        _documents,
        "doc_id bigint, part bigint, block bigint, inner bigint, n_tokens bigint, ids_crc32 bigint",
    )
    return lookup_join(docs, blocks, ["part", "block"]).select(
        "doc_id", (F.col("outer") + F.col("middle") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )

"""Links among the members of candidate buckets, without listing all pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.operators.scale import lookup_join

#: A bucket of more members is dealt out in chunks of about this size.
CELL = 1_024
#: Small cells leave Arrow together, about so much of their columns at a time.
_TURNED_BYTES = 1 << 20


def spanning_links(size: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Direct links that span every component of ``size`` members.

    ``near(i, others)`` says which of the others are linked to i. A member that
    has been reached is never looked at again, so a bucket of copies takes one
    look at each, and only members that link to nothing meet all others.
    """
    found = []
    rest = np.arange(size)
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = near(i, rest)
            found.extend((i, int(j)) for j in rest[hit])
            queue.extend(rest[hit].tolist())
            rest = rest[~hit]
    return found


def bucket_links(
    members: DataFrame,
    bucket: Sequence[str],
    member: str,
    payload: Sequence[str],
    near: Callable[[dict[str, list | np.ndarray]], Callable[[int, np.ndarray], np.ndarray]],
    cell: int = CELL,
    fetch: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``a, b``: verified links between members that share a bucket.

    ``members`` holds a member (a bigint) at most once per bucket; ``near`` gets
    the columns of one cell and returns the test for ``spanning_links``. The
    links span the same components as all links would, so a group of k members
    yields at most k - 1 of them per cell.

    Buckets are counted first, by partial aggregation, and single members go no
    further; of buckets with the very same members, told by two hashes of the
    set, one is looked at. ``fetch`` may add the payload to the rows that are
    left (by ``_member``), so that it is not carried through the counting. A bucket of up to ``cell`` members is one cell. A larger one is cut
    into chunks by hash and each pair of chunks makes a cell, so no task ever
    holds more than about two chunks and still every pair of members meets.
    """
    sets = [F.bit_xor(F.xxhash64(F.lit(salt), member)).alias(f"_set{salt}") for salt in (1, 2)]
    counts = members.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n"), *sets).where("_n > 1")
    counts = (
        counts.groupBy("_n", "_set1", "_set2")
        .agg(F.min(F.struct(*bucket)).alias("_b"))
        .select("_n", *(F.col(f"_b.{c}").alias(c) for c in bucket))
    )
    chunks = F.ceil(F.col("_n") / cell)
    placed = (
        lookup_join(members.select(*dict.fromkeys([*bucket, member, *([] if fetch else payload)])), counts, bucket)
        .withColumn("_chunks", chunks)
        .withColumn("_own", F.pmod(F.xxhash64(F.lit("chunk"), member), F.col("_chunks")))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_chunks") - 1)))
        .select(
            # Two cells under one hash would only be compared needlessly.
            F.xxhash64(*bucket, F.least("_own", "_other"), F.greatest("_own", "_other")).alias("_cell"),
            F.col(member).alias("_member"),
            *([] if fetch else payload),
        )
    )
    placed = fetch(placed) if fetch else placed
    placed = placed.repartition("_cell").sortWithinPartitions("_cell", "_member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def judged(rows: pa.Table, edges: list[int]) -> list[tuple[int, int]]:
            """Links of the cells between ``edges``; columns leave Arrow for many small cells at once."""
            pairs, first = [], 0
            most = _TURNED_BYTES * rows.num_rows // max(1, rows.nbytes)
            while first < len(edges) - 1:
                last = first + 1
                while last < len(edges) - 1 and edges[last + 1] - edges[first] <= most:
                    last += 1
                part = rows.slice(edges[first], edges[last] - edges[first])
                ids = part.column("_member").to_pylist()
                columns = {
                    p: part.column(p).to_numpy()
                    if pa.types.is_integer(part.schema.field(p).type)
                    else part.column(p).to_pylist()
                    for p in payload
                }
                for k in range(first, last):
                    start, end = edges[k] - edges[first], edges[k + 1] - edges[first]
                    if end - start > 1:
                        own = ids[start:end]
                        links = spanning_links(end - start, near({p: c[start:end] for p, c in columns.items()}))
                        pairs.extend((own[i], own[j]) for i, j in links if own[i] != own[j])
                first = last
            return pairs

        def answer(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*pairs) if pairs else ((), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
            )

        rest = None  # the last cell of a batch, which the next batch may carry on
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows]).combine_chunks()
            cells = rows.column("_cell").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist()]
            pairs = judged(rows, edges)
            rest = rows.slice(edges[-1])
            if pairs:
                yield answer(pairs)
        if rest is not None and (pairs := judged(rest, [0, rest.num_rows])):
            yield answer(pairs)

    return placed.mapInArrow(run, "a bigint, b bigint")

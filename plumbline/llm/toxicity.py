"""Toxicity: a linear-chain conditional random field tags offending words.

Words that labelled toxic documents share and clean ones lack give the token
labels of a bounded sample; the field learns from windows around them. Scoring
runs forward-backward over each whole text. Marginals become a document score
and the offsets of the offending spans.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.chains import Gap, fit_windows, forward_backward
from plumbline.llm.common import ALNUM, as_bytes, stored, thinned

#: Labelled documents fitted at most, those of the smallest id hash.
SAMPLE_ROWS = 12_000
#: Words and word beginnings that may carry a weight of their own; all other words share one.
LEXICON = 2_000
#: Bytes of a beginning that inflected forms may share.
STEMS = (4, 5, 6)
#: A weight needs so many toxic documents and such a likelihood ratio (G squared).
LEAST_DOCS, LEAST_G2 = 6, 30.0
#: Words to either side in a training window; windows around hits per document.
AROUND, WINDOWS = 3, 8
PREDICT = 0.3

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


@dataclass(frozen=True)
class Tagger:
    lexicon: dict[bytes, int]  # forms numbered from 1; 0 is any other word
    unary: np.ndarray
    trans: np.ndarray
    document: np.ndarray  # bias, weights of the two document features


def _marginals(tagger: Tagger, gap: Gap, at: np.ndarray, classes: np.ndarray, n_words: int) -> np.ndarray:
    """P(offending) of the words at ``at`` of ``n_words``; all other words are summed out exactly."""
    if not len(at):
        return np.zeros(0)
    unary = np.exp(tagger.unary[classes])
    plain = np.exp(tagger.unary[0])
    # What comes before the first and after the last one goes into their own potentials.
    steps = gap(np.diff(at) - 1)
    if at[0]:
        unary[0] = unary[0] * (plain @ gap(at[:1] - 1)[0])
    trail = n_words - 1 - at[-1:]
    if trail[0]:
        unary[-1] = unary[-1] * (gap(trail - 1)[0] @ plain)
    return forward_backward(unary, steps)[:, 1]


def _document_features(marginals: np.ndarray) -> tuple[float, float]:
    """Chance that any word offends, and how many are expected to."""
    return float(1 - np.prod(1 - marginals)), float(np.log1p(marginals.sum()))


def _forms(word: bytes) -> list[bytes]:
    """Entries a word may match: its beginnings, then the word itself."""
    return [b"^" + word[:size] for size in STEMS if len(word) >= size] + [b"=" + word]


def _found(lexicon: dict[bytes, int], words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Places and classes of the words that match an entry; the strongest entry counts."""
    known: dict[bytes, int] = {}
    for word in set(words):
        named = [lexicon[f] for f in _forms(word) if f in lexicon]
        if named:
            known[word] = min(named)
    if not known:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hits = [(i, known[w]) for i, w in enumerate(words) if w in known]
    at, classes = zip(*hits)
    return np.array(at, np.int64), np.array(classes, np.int64)


def sample(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled documents for which ``learn`` holds, written once.

    Ids on several rows of ``labels`` count once, as toxic if any says so.
    """
    chosen = (
        thinned(labels.where(learn & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)), rows, "doc_id")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # Bounded by ``rows``: two numbers each.
    return stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "toxic-sample")


def _lexicon(rows: DataFrame) -> dict[bytes, int]:
    """Entries by strength, from document counts over the whole sample."""

    @F.arrow_udf("array<binary>")
    def forms(texts: pa.Array) -> pa.Array:
        found = [
            sorted({f for w in set(t.translate(ALNUM).split()) for f in _forms(w)}) for t in as_bytes(texts)
        ]
        return pa.array(found, pa.list_(pa.binary()))

    totals = rows.agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n")).first()
    share = (totals.bad or 0) / max(totals.n, 1)
    bad, n = F.col("bad"), F.col("n")
    good = n - bad
    part = bad * F.log(bad / (n * share)) if share else F.lit(0.0)
    rest = F.when(good > 0, good * F.log(good / (n * (1 - share)))).otherwise(0.0) if share < 1 else F.lit(0.0)
    top = (
        rows.select("toxic", F.explode(forms("text")).alias("form"))
        .groupBy("form")
        .agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n"))
        .where((bad >= LEAST_DOCS) & (bad > n * share))
        .withColumn("g2", 2 * (part + rest))
        .where(F.col("g2") >= LEAST_G2)
        .orderBy(F.col("g2").desc(), "form")
        .limit(LEXICON)
        .collect()
    )
    return {bytes(r.form): i + 1 for i, r in enumerate(top)}


def _windows(lexicon: dict[bytes, int]) -> Callable:
    """Word classes and token labels of windows around lexicon words and at even places."""
    width = 2 * AROUND + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, labels = [], []
            for text, toxic in zip(as_bytes(batch.column(0)), batch.column(1).to_pylist()):
                words = text.translate(ALNUM).split()
                kind = np.zeros(len(words) + 2 * AROUND, np.int64)
                at, found = _found(lexicon, words)
                kind[at + AROUND] = found
                even = np.linspace(0, max(len(words) - 1, 0), 3).astype(int) if words else []
                for i in sorted({*at[:: max(1, len(at) // WINDOWS)].tolist(), *map(int, even)}):
                    window = kind[i : i + width]
                    classes.append(window.tolist())
                    labels.append(((window > 0) & bool(toxic)).astype(int).tolist())
            kinds = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(classes, kinds), pa.array(labels, kinds)], names=["classes", "labels"]
            )

    return run


def fit(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> Tagger:
    """Fit on a bounded sample; only windows of word numbers and two figures per document reach the driver."""
    chosen = sample(docs, labels, learn, rows)
    lexicon = _lexicon(chosen)
    width = 2 * AROUND + 1
    windows = chosen.select("text", "toxic").mapInArrow(
        _windows(lexicon), "classes array<bigint>, labels array<bigint>"
    )
    kept = windows.collect()  # at most (WINDOWS + a few) x rows
    shape = (-1, width)
    unary, trans = fit_windows(
        np.array([r.classes for r in kept], np.int64).reshape(shape),
        np.array([r.labels for r in kept], np.int64).reshape(shape),
        len(lexicon) + 1,
    )
    tagger = Tagger(lexicon, unary, trans, np.zeros(3))
    scored = chosen.select("toxic", _tag(tagger)("text")["features"].alias("x")).collect()
    x = np.array([[1.0, *r.x] for r in scored], float).reshape(-1, 3)
    y = np.array([r.toxic for r in scored], float)
    return Tagger(lexicon, unary, trans, _logistic(x, y))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Logistic weights by Newton steps; without rows, a score of 0.1 for all."""
    weights = np.zeros(3)
    rate = (y.sum() + 0.1) / (len(y) + 1)
    weights[0] = np.log(rate / (1 - rate))
    ridge = np.diag([1e-6, 0.5, 0.5])
    for _ in range(rounds if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (y - p) - ridge @ weights
        weights = weights + np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, slope)
    return weights


def _tag(tagger: Tagger) -> Callable:
    """A column function from text to document features, score and spans."""
    ddl = (
        "features array<double>, score double, predicted int, "
        "spans array<struct<start:int,end:int,chance:double>>"
    )
    kind = pa.struct(
        [
            ("features", pa.list_(pa.float64())),
            ("score", pa.float64()),
            ("predicted", pa.int32()),
            (
                "spans",
                pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("chance", pa.float64())])),
            ),
        ]
    )

    @F.arrow_udf(ddl)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        gap = Gap(np.exp(tagger.trans), np.exp(tagger.unary[0]))
        for texts in batches:
            rows = []
            for text in as_bytes(texts):
                flat = text.translate(ALNUM)
                words = flat.split()
                at, classes = _found(tagger.lexicon, words)
                chance = _marginals(tagger, gap, at, classes, len(words))
                x = _document_features(chance)
                score = 1 / (1 + np.exp(-np.clip(tagger.document @ (1.0, *x), -30, 30)))
                rows.append(
                    {
                        "features": x,
                        "score": float(score),
                        "predicted": int(score >= PREDICT),
                        "spans": _spans(text, flat, at, chance),
                    }
                )
            yield pa.array(rows, kind)

    return run


def _spans(text: bytes, flat: bytes, at: np.ndarray, chance: np.ndarray) -> list[dict]:
    """Code point offsets of runs of neighbouring words that more likely than not offend."""
    bad = chance >= 0.5
    if not bad.any():
        return []
    places = [m.span() for m in _WORD.finditer(flat)]
    spans: list[dict] = []
    previous = -2
    for i, p in zip(at[bad].tolist(), chance[bad].tolist()):
        start, end = (len(text[:b].decode()) for b in places[i])
        if i == previous + 1:
            spans[-1] |= {"end": end, "chance": max(spans[-1]["chance"], p)}
        else:
            spans.append({"start": start, "end": end, "chance": p})
        previous = i
    return spans


def toxicity(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """All columns of ``docs`` and a record ``toxicity``: score, predicted, spans.

    ``learn`` says which rows of ``labels`` may be learned from. Scores depend
    on the text alone. Null and empty texts score like any text without an
    offending word; equal texts get equal scores; without labels every text
    scores 0.1. A column named ``toxicity`` is replaced.
    """
    return docs.withColumn("toxicity", _tag(fit(docs, labels, learn, rows))("text"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from learning: those whose id, as text, has a CRC-32 of remainder 2 by 4."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2

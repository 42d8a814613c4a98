"""Quality rules: gradient-boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled rows, with monotonic
constraints on chosen statistics, and flattened into node arrays that numpy
walks for a whole batch at once. The fit sees numbers only, never texts: the
statistics of the sample are computed on the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import as_bytes, thinned
from plumbline.llm.text_stats import FEATURES, features

#: At most so many labelled rows, those of the smallest id hash, are fitted.
SAMPLE_ROWS = 6_000
#: +1: a larger value may only raise the score, -1: may only lower it.
MONOTONE = {
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "upper_share": -1,
    "distinct_share": 1,
}
#: A text is kept if its chance of good quality reaches this.
KEEP = 0.5

_RESULT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, score double, kept boolean"
)


@dataclass(frozen=True)
class Trees:
    """Flattened trees. Node k of tree t: go left if x[feature] <= cut; leaves point to themselves."""

    feature: np.ndarray  # (trees, nodes)
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                below = x[rows, self.feature[t, at]] <= self.cut[t, at]
                at = np.where(below, self.left[t, at], self.right[t, at])
            total += self.value[t, at]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def _gain(g, h, reg):
    return g * g / (h + reg)


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    monotone: np.ndarray,
    trees: int = 40,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    reg: float = 2.0,
    least: float = 2.0,
) -> Trees:
    """Logistic boosting on binned columns.

    A split on a constrained column is taken only if its two leaf values are in
    order; their middle then bounds all values further down on either side, so
    the whole tree is monotonic in that column. Without rows the score is 1/2;
    with one class only it is that class's rate and no tree splits.
    """
    nodes = 2 ** (depth + 1) - 1
    feature = np.zeros((trees, nodes), np.int64)
    cut = np.full((trees, nodes), np.inf)
    left = np.tile(np.arange(nodes), (trees, 1))
    right = left.copy()
    value = np.zeros((trees, nodes))
    rows = len(y)
    rate_y = (y.sum() + 1) / (rows + 2)
    start = float(np.log(rate_y / (1 - rate_y)))
    cuts = [
        np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if rows else np.zeros(0)
        for c in x.T
    ]
    binned = [np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)]
    margin = np.full(rows, start)
    for t in range(trees if rows else 0):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-9)
        todo = [(0, np.arange(rows), -np.inf, np.inf, 0)]
        while todo:
            node, idx, low, high, level = todo.pop()
            g, h = grad[idx].sum(), hess[idx].sum()
            own = float(np.clip(g / (h + reg), low, high))
            best = None
            for j, edges in enumerate(cuts if level < depth else ()):
                if not len(edges):
                    continue
                gs = np.bincount(binned[j][idx], grad[idx], len(edges) + 1).cumsum()[:-1]
                hs = np.bincount(binned[j][idx], hess[idx], len(edges) + 1).cumsum()[:-1]
                lv = np.clip(gs / (hs + reg), low, high)
                rv = np.clip((g - gs) / (h - hs + reg), low, high)
                gain = _gain(gs, hs, reg) + _gain(g - gs, h - hs, reg) - _gain(g, h, reg)
                ok = (hs >= least) & (h - hs >= least)
                if monotone[j]:
                    ok &= monotone[j] * (rv - lv) >= 0
                gain = np.where(ok, gain, -np.inf)
                k = int(gain.argmax())
                if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                    best = (gain[k], j, k, lv[k], rv[k])
            if best is None:
                value[t, node] = rate * own
                margin[idx] += rate * own
                continue
            _, j, k, lv, rv = best
            below = binned[j][idx] <= k
            feature[t, node], cut[t, node] = j, cuts[j][k]
            left[t, node], right[t, node] = 2 * node + 1, 2 * node + 2
            middle = (lv + rv) / 2
            lows, highs = [low, low], [high, high]
            if monotone[j] > 0:
                highs[0], lows[1] = middle, middle
            elif monotone[j] < 0:
                lows[0], highs[1] = middle, middle
            todo.append((2 * node + 1, idx[below], lows[0], highs[0], level + 1))
            todo.append((2 * node + 2, idx[~below], lows[1], highs[1], level + 1))
    return Trees(feature, cut, left, right, value, start, depth)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Fit on the texts of at most ``sample_rows`` labelled documents.

    Rows without an id, a label or a document are left out; so are texts that
    fail the base rules, since the trees never decide on those.
    """
    chosen = (
        thinned(labels.where("doc_id is not null and quality in (0, 1)"), sample_rows, "doc_id")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )

    @F.arrow_udf("array<double>")
    def measure(texts: pa.Array) -> pa.Array:
        return pa.array([features(t)[1] for t in as_bytes(texts)], pa.list_(pa.float64()))

    # Bounded by sample_rows: 16 bytes a row.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "quality", measure("text").alias("x"))
        .limit(4 * sample_rows)
        .collect()
    )
    rows.sort(key=lambda r: (r.doc_id, r.x))
    x = np.array([r.x for r in rows], float).reshape(-1, len(FEATURES))
    y = np.array([r.quality for r in rows], float)
    usable = ~((x[:, 0] < np.log1p(20) - 1e-9) | (x[:, 4] > 0.3))
    return fit_trees(x[usable], y[usable], np.array([MONOTONE.get(f, 0) for f in FEATURES]))


def assess(trees: Trees, keep: float = KEEP) -> Callable:
    """A column function from text to its statistics, score and verdict.

    A null text counts as empty. Texts of fewer than 20 words, or with more
    than 30% of the words in repeated windows, fail the base rules whatever
    the trees say.
    """

    @F.arrow_udf(_RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            base, x = [], []
            for text in as_bytes(texts):
                counts, row = features(text)
                base.append(counts)
                x.append(row)
            counts = np.array(base, np.int64).reshape(-1, 5)
            score = trees.score(np.array(x, float).reshape(-1, len(FEATURES)))
            n, repeat = counts[:, 0], counts[:, 4]
            failed = (n < 20) | (100 * repeat > 30 * n)
            columns = [*counts.T, failed, score, ~failed & (score >= keep)]
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            yield pa.StructArray.from_arrays(
                [pa.array(np.ascontiguousarray(c)) for c in columns],
                names=[*names, "base_failed", "score", "kept"],
            )

    return run


def quality_rules(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """All columns of ``docs`` and a record ``quality_verdict`` for every row.

    Nothing is dropped or shuffled; equal rows get equal verdicts, an empty
    table gives an empty one. A column named ``quality_verdict`` is replaced.
    """
    return docs.withColumn("quality_verdict", assess(fit(docs, labels), keep)("text"))


def keep_good(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` that are kept, columns unchanged."""
    return docs.where(assess(fit(docs, labels), keep)("text")["kept"])

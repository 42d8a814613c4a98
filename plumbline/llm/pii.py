"""Personal data: base patterns, and a skip-chain conditional random field that adds spans.

The chain runs over the tokens of a text that hold a digit or an at sign; the
words between them are summed out. Distant tokens that are equal or alike share
a skip potential, and loopy message passing carries labels between them, so
that a number found once in full is also found where it stands in another form.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.chains import Gap
from plumbline.llm.common import digest, stored, thinned

#: Texts that the field is fitted on at most, and tokens of one text.
SAMPLE_ROWS, SAMPLE_TOKENS = 4_000, 200
#: A token gets a label at this chance.
CHANCE = 0.5
#: Rounds of message passing and the share of the old message that stays.
ROUNDS, DAMPING = 25, 0.3

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Repeats that cannot match later are possessive,
# and a run of digits is only tried from its start; both leave the matches as they are.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_SOME = re.compile("[0-9@]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_DIGIT = re.compile("[0-9]")
_EDGE = re.compile(r"^[^\w+(]+|[^\w)]+$")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches found from their at sign: the local part is what stands before it, back to the last match."""
    done = 0
    for match in _DOMAIN.finditer(text):
        at = start = match.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            done = match.end()
            yield start, done


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start."""
    found = [(0, *span) for span in _emails(text)]
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m.group().split("."))
        if all(len(p) < 4 and int(p or 0) < 256 for p in parts):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m.group())) <= 15:
            found.append((3, *m.span()))
    return found


# --- tokens and their features -------------------------------------------------------

_SIZES = (1, 2, 3, 4, 8, 12, 19)


def tokens(text: str) -> tuple[list[tuple[int, int]], list[int]]:
    """Spans of the tokens with a digit or an at sign, and their places among all tokens."""
    spans, places = [], []
    for i, m in enumerate(_TOKEN.finditer(text)):
        if _SOME.search(m.group()):
            spans.append(m.span())
            places.append(i)
    return spans, places


def token_features(text: str, spans: list[tuple[int, int]], places: list[int]) -> np.ndarray:
    """Shape of each token and of its neighbours: no token's own characters."""
    n = len(spans)
    words = [text[a:b] for a, b in spans]
    digits = ["".join(_DIGIT.findall(w)) for w in words]
    own = np.zeros((n, 24))
    for i, (w, d) in enumerate(zip(words, digits)):
        size = sum(len(d) > s for s in _SIZES)
        own[i, size] = 1
        at = w.find("@")
        own[i, 8:24] = (
            at >= 0,
            at > 0 and "." in w[at:].rstrip("."),
            w[0] == "+",
            w[0] == "(",
            w.rstrip(".,;:!?")[-1:] == ")",
            "-" in w,
            w.strip(".").count(".") == 3,
            w.strip(".").count(".") in (1, 2),
            w.rstrip(".,;:!?").isdigit(),
            any(c.isalpha() for c in w),
            "=" in w or '"' in w,
            13 <= len(d) <= 19 and luhn(d),
            13 <= len(d) <= 19 and not luhn(d),
            not d,
            len(w) > 24,
            1,
        )
    place = np.array(places)
    near = np.diff(place) == 1 if n > 1 else np.zeros(0, bool)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:][near] = own[:-1][near]
    after[:-1][near] = own[1:][near]
    return np.hstack([own, before, after])


def alike(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Skip edges: each token and the next one with the same digits, or the same letters and digits."""
    edges = set()
    last: dict[str, int] = {}
    for i, (a, b) in enumerate(spans):
        word = text[a:b]
        digits = "".join(_DIGIT.findall(word))
        keys = {"w" + "".join(c for c in word.lower() if c.isalnum() or c == "@")}
        if len(digits) >= 4:
            keys.add("d" + digits)
        for key in keys:
            if key in last:
                edges.add((last[key], i))
            last[key] = i
    return sorted(edges)


# --- the field -------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    weights: np.ndarray  # (features, labels)
    step: np.ndarray  # (labels, labels): neighbours in the chain
    skip: np.ndarray  # (labels, labels): distant tokens that are alike


_LABELS = 1 + len(KINDS)
#: A word without digit or at sign: almost surely of no kind.
_PLAIN = np.exp([0.0] + [-8.0] * len(KINDS))


def token_labels(spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> np.ndarray:
    """Label of each token: the kind of the base span it touches, else 0; the first kind listed wins."""
    labels = np.zeros(len(spans), np.int64)
    starts = np.array([s for s, _ in spans])
    ends = np.array([e for _, e in spans])
    for kind, start, end in reversed(base):
        a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(starts, end)
        labels[a:b] = kind + 1
    return labels


def pass_messages(
    unary: np.ndarray, edges: np.ndarray, potentials: np.ndarray, rounds: int = ROUNDS
) -> np.ndarray:
    """Loopy sum-product: approximate marginals of every node.

    ``edges`` (m, 2), ``potentials`` (m, k, k) from the first to the second
    end. All messages change at once, damped; a tree gives exact marginals once
    they have crossed it.
    """
    n, k = unary.shape
    own = np.log(np.maximum(unary, 1e-300))
    m = len(edges)
    to = np.concatenate([edges[:, 1], edges[:, 0]]) if m else np.zeros(0, int)
    source = np.concatenate([edges[:, 0], edges[:, 1]]) if m else to
    pot = np.concatenate([potentials, potentials.transpose(0, 2, 1)]) if m else np.zeros((0, k, k))
    back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    sent = np.full((2 * m, k), -np.log(k))
    belief = own
    for _ in range(rounds):
        belief = own.copy()
        np.add.at(belief, to, sent)
        without = belief[source] - sent[back]
        without -= without.max(axis=1, keepdims=True)
        new = np.einsum("ek,ekl->el", np.exp(without), pot)
        new = np.log(np.maximum(new / new.sum(axis=1, keepdims=True), 1e-300))
        moved = np.abs(new - sent).max(initial=0.0)
        sent = DAMPING * sent + (1 - DAMPING) * new
        if moved < 1e-4:
            break
    belief = own.copy()
    np.add.at(belief, to, sent)
    belief = np.exp(belief - belief.max(axis=1, keepdims=True))
    return belief / belief.sum(axis=1, keepdims=True)


def added_spans(field: Field, gap: Gap, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the tokens that the field labels and no base span touches."""
    spans, places = tokens(text)
    n = len(spans)
    if not n:
        return []
    known = token_labels(spans, base)
    if (known > 0).all():
        return []
    score = token_features(text, spans, places) @ field.weights
    unary = np.exp(score - score.max(axis=1, keepdims=True))
    # What a base pattern found is evidence.
    seen = known > 0
    unary[seen] = np.where(np.eye(_LABELS)[known[seen]] > 0, 1.0, 1e-6)
    skips = alike(text, spans)
    chain = np.stack([np.arange(n - 1), np.arange(1, n)], axis=1)
    edges = np.concatenate([chain, np.array(skips, int).reshape(-1, 2)])
    potentials = np.concatenate(
        [gap(np.diff(places) - 1), np.broadcast_to(field.skip, (len(skips), _LABELS, _LABELS))]
    )
    marginals = pass_messages(unary, edges, potentials)
    label = np.where(1 - marginals[:, 0] >= CHANCE, marginals[:, 1:].argmax(axis=1) + 1, 0)
    label[seen] = 0
    found: list[tuple[int, int, int]] = []
    previous = -2
    for i in np.flatnonzero(label).tolist():
        start, end = spans[i]
        word = text[start:end]
        lead, tail = _EDGE.match(word), _EDGE.search(word, 1)
        start += lead.end() if lead else 0
        end -= len(word) - tail.start() if tail else 0
        if end <= start:
            continue
        kind = int(label[i]) - 1
        if previous == i - 1 and found[-1][0] == kind and places[i] == places[i - 1] + 1:
            found[-1] = (kind, found[-1][1], end)
        else:
            found.append((kind, start, end))
        previous = i
    return found


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Field:
    """Piecewise training on at most ``rows`` texts that hold a digit or an at sign.

    The base patterns label the tokens. Unary weights are those of a
    multinomial logistic model, step and skip potentials log-ratios of label
    pairs over what their frequencies make likely. Only shapes and labels of at
    most ``SAMPLE_TOKENS`` tokens a text reach the driver.
    """
    texts = stored(
        thinned(docs.where(F.col("text").rlike("[0-9@]")).select("text"), rows, "text")
        .distinct()
        .orderBy(F.xxhash64("text"), "text")
        .limit(rows),
        "pii-sample",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                spans, places = tokens(text)
                labels = token_labels(spans, base_spans(text))
                x = token_features(text, spans, places)[:SAMPLE_TOKENS]
                skips = [e for e in alike(text, spans) if e[1] < SAMPLE_TOKENS]
                out.append((x, labels[:SAMPLE_TOKENS], places[:SAMPLE_TOKENS], skips))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([np.packbits(x > 0, axis=1).tobytes() for x, *_ in out], pa.binary()),
                    pa.array([y.tolist() for _, y, *_ in out], pa.list_(pa.int64())),
                    pa.array([p for _, _, p, _ in out], pa.list_(pa.int64())),
                    pa.array([[i for e in s for i in e] for *_, s in out], pa.list_(pa.int64())),
                ],
                names=["x", "labels", "places", "skips"],
            )

    ddl = "x binary, labels array<bigint>, places array<bigint>, skips array<bigint>"
    found = texts.mapInArrow(run, ddl).collect()
    return _trained(found)


def _trained(found: list) -> Field:
    width = 72
    xs, ys = [np.zeros((0, width))], [np.zeros(0, np.int64)]
    steps, skips = np.ones((_LABELS, _LABELS)), np.ones((_LABELS, _LABELS)) * 0.5
    for row in found:
        y = np.array(row.labels, np.int64)
        xs.append(np.unpackbits(np.frombuffer(row.x, np.uint8).reshape(len(y), -1), axis=1)[:, :width].astype(float))
        ys.append(y)
        near = np.diff(row.places) == 1
        np.add.at(steps, (y[:-1][near], y[1:][near]), 1)
        # A plain word in between has label 0.
        np.add.at(steps, (y[:-1][~near], np.zeros((~near).sum(), int)), 1)
        np.add.at(steps, (np.zeros((~near).sum(), int), y[1:][~near]), 1)
        pairs = np.array(row.skips, np.int64).reshape(-1, 2)
        np.add.at(skips, (y[pairs[:, 0]], y[pairs[:, 1]]), 1)
    x, y = np.concatenate(xs), np.concatenate(ys)
    step = steps / np.outer(steps.sum(axis=1), steps.sum(axis=0)) * steps.sum()
    skips = skips + skips.T
    skip = skips / np.outer(skips.sum(axis=1), skips.sum(axis=0)) * skips.sum()
    return Field(_multinomial(x, y), step, np.clip(skip, 1e-3, 1e3))


def _multinomial(x: np.ndarray, y: np.ndarray, rounds: int = 300, ridge: float = 1e-3) -> np.ndarray:
    """Multinomial logistic weights by accelerated gradient steps; zero but for the first label without rows."""
    weights = np.zeros((x.shape[1], _LABELS))
    if not len(y):
        weights[23, 0] = 8.0
        return weights
    one, speed = np.eye(_LABELS)[y], np.zeros_like(weights)
    rate = 4.0 / max(1.0, float((x * x).sum(axis=1).max()))
    for _ in range(rounds):
        score = x @ weights
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        speed = 0.9 * speed + x.T @ (one - p) / len(y) - ridge * weights
        weights += rate * speed
    return weights


# --- the operator ------------------------------------------------------------------------


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(field: Field) -> Callable:
    """A column function from text to counts, base spans and all spans."""
    names = [f"n_{k}" for k in KINDS]
    ddl = ", ".join(f"{n} bigint" for n in names) + ", base string, spans string"

    @F.arrow_udf(ddl)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        gap = Gap(field.step, _PLAIN)
        for texts in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            base, every = [], []
            for value in texts:
                text = value.as_py() or ""
                spans, more = [], []
                if _SOME.search(text):
                    spans = base_spans(text)
                    more = added_spans(field, gap, text, spans)
                for k, column in enumerate(counts):
                    column.append(sum(s[0] == k for s in spans))
                base.append(_written(spans))
                every.append(_written([*spans, *more]))
            yield pa.StructArray.from_arrays(
                [*(pa.array(c, pa.int64()) for c in counts), pa.array(base), pa.array(every)],
                names=[*names, "base", "spans"],
            )

    return run


def personal_data(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """All columns of ``docs`` and a record ``personal_data``.

    It holds the number of base spans by kind, the base spans and all spans, as
    ``kind:start:end`` in code points. Null and empty texts have none; nothing
    is dropped or shuffled. A column named ``personal_data`` is replaced.
    """
    return docs.withColumn("personal_data", find(fit(docs, rows))("text"))


def report(docs: DataFrame) -> DataFrame:
    found = personal_data(docs.select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(f"personal_data.n_{k}" for k in KINDS),
        digest(F.col("personal_data.base")).alias("base_sha256"),
        "personal_data.spans",
    )

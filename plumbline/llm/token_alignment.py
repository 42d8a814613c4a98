"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Each text is encoded by two tokenizers: A (byte-level BPE, run on space + text)
and B (a piece model, which puts the space in front itself), word by word, as
neither joins a word's end to the space behind it. Their tokens are
rows of two token-by-byte incidence matrices, built by hand in CSR form. The
Gustavson row product A·Bᵀ (for each A row, the B rows of its byte columns)
gives the overlap links; the places where a run of overlaps ends in both cut
the text into groups, and the product of the group-incidence matrices
G_A·G_Bᵀ gives the shared-group links: every A-B token pair of a group.

Per document only sizes, a digest of the groups and the distinct linked id
pairs with their multiplicities leave Python. Corpus-wide counts of id pairs
(documents that hold the pair linked) and the best count of each A id are
aggregations on Spark; the per-document sums are joins back by id pair.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, functions as F
from tokenizers.pre_tokenizers import ByteLevel

from plumbline.llm.common import stored
from plumbline.operators.scale import lookup_join

#: Vocabulary files of the two tokenizers (a parameter; never copied here).
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
_PIECE_BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>")
_SPACE_MARK = "▁"


def _byte_level() -> dict[str, int]:
    """The byte-level alphabet as a rule: printable Latin-1 bytes stand for themselves, the
    other bytes take the code points from 256 on, in byte order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    chars, extra = {}, 0
    for b in range(256):
        if b in shown:
            chars[chr(b)] = b
        else:
            chars[chr(256 + extra)] = b
            extra += 1
    return chars


@lru_cache(maxsize=4)
def tokenizers(a_path: str, b_path: str):
    """Both tokenizers and the bytes of every id; loaded once per Python worker."""
    import sentencepiece
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True  # control strings inside texts are plain text
    alphabet = _byte_level()
    a_bytes = []
    for i in range(a.get_vocab_size(with_added_tokens=True)):
        token = a.id_to_token(i) or ""
        a_bytes.append(bytes(alphabet.get(c, ord(c) & 0xFF) for c in token))
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    b_bytes = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        hit = _PIECE_BYTE.fullmatch(piece)
        b_bytes.append(bytes([int(hit.group(1), 16)]) if hit else piece.replace(_SPACE_MARK, " ").encode())
    sizes = lambda table: np.array([len(t) for t in table], np.int64)
    return a, b, a_bytes, b_bytes, sizes(a_bytes), sizes(b_bytes)


def align(a_ids: np.ndarray, b_ids: np.ndarray, a_len: np.ndarray, b_len: np.ndarray):
    """Groups and shared-group links of one text whose A and B bytes are equal.

    Returns group of each A token, group of each B token, and per group the
    distinct linked id pairs: group, a, b, multiplicity.
    """
    n_a = len(a_ids)
    # CSR of A (tokens by bytes): row i holds the byte columns ends[i-1] .. ends[i]-1.
    a_ptr = np.concatenate([[0], np.cumsum(a_len)])
    a_cols = np.arange(a_ptr[-1])
    # Bᵀ (bytes by tokens): each byte column has the one B token that covers it.
    bt = np.repeat(np.arange(len(b_ids)), b_len)
    # Gustavson: row i of A·Bᵀ gathers the Bᵀ rows of A's columns in row i.
    rows = np.repeat(np.arange(n_a), np.diff(a_ptr))
    cols = bt[a_cols]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (cols[1:] != cols[:-1])
    rows, cols = rows[new], cols[new]  # overlap links, in row then column order
    starts = np.searchsorted(rows, np.arange(n_a))
    lo, hi = cols[starts], cols[np.append(starts[1:], len(cols)) - 1]
    # A group ends where an A token ends at a B token's end: no overlap carries over.
    cut = np.ones(n_a, bool)
    cut[1:] = hi[:-1] != lo[1:]
    group_a = np.cumsum(cut) - 1
    group_b = np.empty(len(b_ids), np.int64)
    group_b[cols] = group_a[rows]
    # G_A·G_Bᵀ over distinct ids per group: (a, b) occurs cA_g(a) * cB_g(b) times in group g.
    ga, ca = _summed(group_a * (1 << 32) + a_ids)
    gb, cb = _summed(group_b * (1 << 32) + b_ids)
    g_of_a, g_of_b = ga >> 32, gb >> 32
    groups = int(group_a[-1]) + 1
    b_start = np.searchsorted(g_of_b, np.arange(groups))
    b_count = np.bincount(g_of_b, minlength=groups)
    reps = b_count[g_of_a]
    left = np.repeat(np.arange(len(ga)), reps)
    right = _runs(b_start[g_of_a], reps)
    return group_a, group_b, g_of_a[left], ga[left] & 0xFFFFFFFF, gb[right] & 0xFFFFFFFF, ca[left] * cb[right]


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start .. start + size - 1`` of each run, one run after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _summed(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of ``times`` of each (1 if left out)."""
    order = np.sort(keys)
    first = np.ones(len(order), bool)
    first[1:] = order[1:] != order[:-1]
    at = np.flatnonzero(first)
    distinct, sums = order[at], np.diff(np.append(at, len(order)))
    if times is not None:
        # Nearly all are 1; what the others have beyond it is added in place.
        more = np.flatnonzero(times != 1)
        np.add.at(sums, np.searchsorted(distinct, keys[more]), times[more] - 1)
    return distinct, sums


def _shown(ids: int, last: str) -> np.ndarray:
    """Each id in decimal with a comma behind it (row 0) or with ``last`` (row 1)."""
    return np.array([[f"{i}{mark}" for i in range(ids)] for mark in (",", last)], "S")


def groups_text(a_ids, b_ids, group_a, group_b, a_shown, b_shown) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;``: decimal ids of each group, A then B; and where each group ends."""
    tokens = []
    for ids, group, shown in ((a_ids, group_a, a_shown), (b_ids, group_b, b_shown)):
        last = np.append(group[1:] != group[:-1], True)
        tokens.append(shown[last.astype(np.intp), ids])
    side = np.concatenate([2 * group_a, 2 * group_b + 1])
    order = np.argsort(side, kind="stable")  # two runs to merge
    text = np.concatenate(tokens)[order]
    ends = np.cumsum(np.char.str_len(text))[np.cumsum(np.bincount(group_a) + np.bincount(group_b)) - 1]
    return text.tobytes().translate(None, b"\0"), ends


_OUT = ["_row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"]
#: New words are encoded about this many characters at a time (the library keeps about
#: 600 bytes per token until they are done).
CHUNK_CHARS = 1 << 16
#: Texts are taken in runs of about this many bytes.
TEXT_BYTES = 1 << 20
#: Words, and characters of words, remembered per Python worker; longer words are forgotten first.
REMEMBER, REMEMBER_CHARS, LONG = 300_000, 16 << 20, 64
#: Neither tokenizer lets a token cross from a character that is no white space (nor the
#: piece model's space mark) to a space behind it.
_CUT = re.compile("(?<=[^\\s\u180e\u2581]) (?!\\Z)")
_NO_CUT = re.compile("[\\s\u180e\u2581]\\Z|\\A\\Z")
_PAIR = pa.struct([("a", pa.int64()), ("b", pa.int64()), ("m", pa.int64())])


class Words:
    """Alignments of words, each with the space before it; a text is its words one after the other.

    A's pre-tokenizer begins a piece at each space that follows something else,
    and no piece of B holds a space mark behind another character (both are
    checked; other tokenizers get whole texts), so that both encode a text as they encode its words, and
    every such place ends a group. Each word is aligned once and remembered.
    """

    def __init__(self, a_path: str, b_path: str, remember: int = REMEMBER, remember_chars: int = REMEMBER_CHARS):
        self.a, self.b, self.a_bytes, self.b_bytes, self.a_size, self.b_size = tokenizers(a_path, b_path)
        pieces = map(self.b.id_to_piece, range(self.b.get_piece_size()))
        split = self.a.pre_tokenizer
        self.cuts = (
            isinstance(split, ByteLevel)
            and split.use_regex
            and self.a.normalizer is None
            and not any(_SPACE_MARK in p.lstrip(_SPACE_MARK) for p in pieces)
        )
        self.remember, self.remember_chars = remember, remember_chars
        self.b_ids, self.span = len(self.b_bytes), len(self.a_bytes) * len(self.b_bytes)
        self.shown = _shown(len(self.a_bytes), "|"), _shown(len(self.b_bytes), ";")
        self.known: dict[str, int] = {}  # place in the tables, in their order
        self.uncut: set[str] = set()  # words that no cut may follow
        self.other: set[str] = set()  # words whose bytes differ
        self.chars = 0
        self.texts: list[bytes] = []
        self.used = np.zeros(0, np.int64)
        self.sizes = np.zeros((0, 4), np.int64)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.keys, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep short words met more than once, at most half of what may be remembered."""
        words = list(self.known)
        used = np.where(np.fromiter(map(len, words), np.int64, len(words)) > LONG, 0, self.used)
        used[[self.known[w] for w in self.uncut if w in self.known]] = 0  # seen as such when they come again
        keep = np.argsort(-used, kind="stable")[: self.remember // 2]
        keep = np.sort(keep[used[keep] > 1])
        pick = _runs(self.start[keep], self.count[keep])
        self.keys, self.times = self.keys[pick], self.times[pick]
        self.sizes, self.count, self.used = self.sizes[keep], self.count[keep], self.used[keep] // 2
        self.start = np.cumsum(self.count) - self.count
        keep = keep.tolist()
        self.texts = list(map(self.texts.__getitem__, keep))
        self.known = dict(zip(map(words.__getitem__, keep), range(len(keep))))
        self.chars = sum(map(len, self.known))
        self.uncut, self.other = set(), set()

    def split(self, text: str) -> list[str]:
        """The words of a text, one space taken from between each two."""
        return _CUT.split(text) if self.cuts else [text]

    def _words(self, texts: list[str]) -> tuple[list[list[str]], set[str]]:
        """The words of each text, and which of them are new."""
        if not self.cuts:
            words = [[t] for t in texts]
            return words, self._new(words)
        words = [t.split(" ") for t in texts]
        # Nearly all texts have cuts at all their spaces; the words that allow none are remembered.
        new = self._new(words)
        uncut = set(filter(_NO_CUT.search, new)).difference(self.uncut)
        self.uncut |= uncut
        self.chars += sum(map(len, uncut))
        if self.uncut:
            words = [
                own if own[-1] and self.uncut.isdisjoint(own[:-1]) else self.split(t) for t, own in zip(texts, words)
            ]
            new = self._new(words)
        return words, new

    def _new(self, words: list[list[str]]) -> set[str]:
        return set(filterfalse(self.known.__contains__, chain.from_iterable(words)))

    def _tokens(self, lines: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        a = self.a.encode_batch_fast([" " + t for t in lines], add_special_tokens=False)
        b = self.b.encode(lines, num_threads=1)
        return [np.array(e.ids, np.int64) for e in a], [np.array(x, np.int64) for x in b]

    def _same_bytes(self, line: str, a_ids: np.ndarray, b_ids: np.ndarray) -> bool:
        target = (" " + line).encode()
        return (
            b"".join(map(self.a_bytes.__getitem__, a_ids.tolist())) == target
            and b"".join(map(self.b_bytes.__getitem__, b_ids.tolist())) == target
        )

    def _learn(self, words: set[str]) -> None:
        """Align new words, joined by their spaces to lines, those that no cut may follow alone."""
        lines, line, size = [], [], 0
        for word in words:
            if not self.cuts or _NO_CUT.search(word):
                self.uncut.add(word)
                lines.append([word])
                continue
            line.append(word)
            size += len(word) + 1
            if size >= 2_000:
                lines.append(line)
                line, size = [], 0
        if line:
            lines.append(line)
        run, size = [], 0
        for line in lines:
            run.append(line)
            size += sum(map(len, line))
            if size >= CHUNK_CHARS:
                self._learn_lines(run)
                run, size = [], 0
        if run:
            self._learn_lines(run)

    def _learn_lines(self, lines: list[list[str]]) -> None:
        joined = list(map(" ".join, lines))
        good, a_of, b_of, again = [], [], [], []
        for line, text, a_ids, b_ids in zip(lines, joined, *self._tokens(joined)):
            if self._same_bytes(text, a_ids, b_ids):
                good += line
                a_of.append(a_ids)
                b_of.append(b_ids)
            elif len(line) > 1:
                again += [[word] for word in line]
            else:
                self.other.add(line[0])
                self.chars += len(line[0])
        if good:
            self._add(good, np.concatenate(a_of), np.concatenate(b_of))
        if again:
            self._learn_lines(again)

    def _add(self, words: list[str], a_ids: np.ndarray, b_ids: np.ndarray) -> None:
        a_len, b_len = self.a_size[a_ids], self.b_size[b_ids]
        group_a, group_b, group, a, b, times = align(a_ids, b_ids, a_len, b_len)
        shown, shown_end = groups_text(a_ids, b_ids, group_a, group_b, *self.shown)
        # Bytes up to the end of each word, hence its tokens and groups.
        ends = np.cumsum([1 + len(w.encode()) for w in words])
        a_end = np.searchsorted(np.cumsum(a_len), ends) + 1
        b_end = np.searchsorted(np.cumsum(b_len), ends) + 1
        g_end = group_a[a_end - 1] + 1
        n_a, n_b = np.bincount(group_a), np.bincount(group_b)
        links = np.append(0, np.cumsum(n_a * n_b))[g_end]
        parts = [np.diff(x, prepend=0) for x in (a_end, b_end, g_end, links)]
        word = np.searchsorted(g_end, group, side="right")
        # Rows come in the order of groups, hence of words; equal pairs of one word are summed.
        keys, times = _summed(word * self.span + a * self.b_ids + b, times)
        word, keys = np.divmod(keys, self.span)
        count = np.bincount(word, minlength=len(words))
        first = len(self.texts)
        self.known.update(zip(words, range(first, first + len(words))))
        shown_end = shown_end[g_end - 1].tolist()
        self.texts += [shown[x : y - 1] for x, y in zip([0, *shown_end], shown_end)]
        self.chars += sum(map(len, words))
        self._fresh.append((np.stack(parts, 1), count, keys, times))

    def know(self, words: list[list[str]], new: set[str]) -> None:
        """Learn the new ones of ``words``; if they do not fit any more, rare ones are forgotten first."""
        if not new.difference(self.other):
            return
        if len(self.known) + len(self.uncut) + len(new) > self.remember or self.chars > self.remember_chars:
            self._forget()
            new = self._new(words)
        self._fresh: list[tuple] = []
        self._learn(new.difference(self.other))
        if self._fresh:
            sizes, count, keys, times = map(np.concatenate, zip(*self._fresh))
            start = len(self.keys) + np.cumsum(count) - count
            self.sizes = np.concatenate([self.sizes, sizes])
            self.start, self.count = np.append(self.start, start), np.append(self.count, count)
            self.used = np.append(self.used, np.zeros(len(count), np.int64))
            self.keys, self.times = np.append(self.keys, keys), np.append(self.times, times)
        self._fresh = []

    def align(self, texts: list[str]):
        """Sizes and digest of each text, and its distinct linked pairs: text, a, b, multiplicity."""
        words, new = self._words(texts)
        self.know(words, new)
        if self.other:
            # It is the bytes of the whole text that count.
            words = [own if self.other.isdisjoint(own) else [t] for t, own in zip(texts, words)]
            self.know(words, self._new(words))
        known = self.known.__getitem__
        places = [[-1] if own[0] in self.other else list(map(known, own)) for own in words]
        counts = np.array([len(p) for p in places])
        at = np.fromiter(chain.from_iterable(places), np.int64, int(counts.sum()))
        of = np.repeat(np.arange(len(texts)), counts)
        bad = np.zeros(len(texts), bool)
        bad[of[at < 0]] = True
        of, at = of[~bad[of]], at[~bad[of]]
        self.used += np.bincount(at, minlength=len(self.used))
        sizes = np.zeros((len(texts), 4), np.int64)
        for c in range(4):
            sizes[:, c] = np.bincount(of, weights=self.sizes[at, c], minlength=len(texts))
        digests = [
            "" if b else hashlib.sha256(b";".join(map(self.texts.__getitem__, p))).hexdigest()
            for b, p in zip(bad.tolist(), places)
        ]
        count = self.count[at]
        pick = _runs(self.start[at], count)
        keys, times = _summed(np.repeat(of, count) * self.span + self.keys[pick], self.times[pick])
        of, keys = np.divmod(keys, self.span)
        return sizes, digests, of, keys // self.b_ids, keys % self.b_ids, times


@lru_cache(maxsize=1)
def words_of(a_path: str, b_path: str) -> Words:
    return Words(a_path, b_path)


def _aligned(a_path: str, b_path: str):
    def run(batches):
        words = words_of(a_path, b_path)
        for batch in batches:
            size = pc.binary_length(batch.column(batch.schema.get_field_index("text"))).fill_null(0)
            runs = np.cumsum(size.to_numpy(zero_copy_only=False), dtype=np.int64) // TEXT_BYTES
            edges = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), batch.num_rows]
            for start, end in zip(edges, edges[1:]):
                yield _aligned_batch(batch.slice(start, end - start), words)

    return run


def _aligned_batch(batch: pa.RecordBatch, words: Words) -> pa.RecordBatch:
    texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
    present = [i for i, t in enumerate(texts) if t]
    sizes = np.zeros((len(texts), 4), np.int64)
    digests = [""] * len(texts)
    n_pairs = np.zeros(len(texts), np.int64)
    pairs = [np.zeros(0, np.int64)] * 3
    if present:
        sizes[present], shown, of, *pairs = words.align([texts[i] for i in present])
        for i, d in zip(present, shown):
            digests[i] = d
        n_pairs[present] = np.bincount(of, minlength=len(present))
    pairs = pa.ListArray.from_arrays(
        pa.array(np.append(0, np.cumsum(n_pairs)), pa.int32()),
        pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in pairs], fields=list(_PAIR)),
    )
    return pa.RecordBatch.from_arrays(
        [
            batch.column(batch.schema.get_field_index("_row")),
            *(pa.array(sizes[:, c], pa.int64()) for c in range(4)),
            pa.array(digests, pa.string()),
            pairs,
        ],
        names=_OUT,
    )


def alignment(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs``.

    Reads ``doc_id, text``; other columns, even of clashing names, are not read.
    A text that is null, empty, or whose joined A or B token bytes differ from
    space + text has no tokens: all counts 0 and ``groups_sha256`` ''. An id
    pair's count is the number of rows (repeated rows each count) that hold it
    linked; ``n_best`` counts links whose pair count is the highest of their A
    id (ties included), ``count_sum`` adds the pair counts over all links, each
    link occurrence once. An empty table gives no rows.
    """
    a_path, b_path = public_tokenizers.path(a_file), public_tokenizers.path(b_file)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "alignment_rows")
    schema = (
        "_row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "pairs array<struct<a:bigint,b:bigint,m:bigint>>"
    )
    aligned = stored(rows.select("_row", "text").mapInArrow(_aligned(a_path, b_path), schema), "alignment")
    # An id pair as one long (ids are below 2**31): the link rows that cross the
    # shuffle are (_row, m, pair) only.
    links = aligned.select("_row", F.explode("pairs").alias("p")).select(
        "_row", "p.m", (F.shiftleft(F.col("p.a"), 32) + F.col("p.b")).alias("pair")
    )
    counts = links.groupBy("pair").agg(F.count(F.lit(1)).alias("docs")).withColumn("a", F.shiftright("pair", 32))
    best = counts.groupBy("a").agg(F.max("docs").alias("best"))
    # Each distinct pair gets its A id's best first, so the links meet one table, once.
    pairs = lookup_join(counts, best, ["a"]).select("pair", "docs", "best")
    scored = lookup_join(links, pairs, ["pair"])
    sums = scored.groupBy("_row").agg(
        F.sum(F.when(F.col("docs") == F.col("best"), F.col("m")).otherwise(0)).alias("n_best"),
        F.sum(F.col("m") * F.col("docs")).alias("count_sum"),
    )
    return (
        rows.select("_row", "doc_id")
        .join(aligned.drop("pairs"), "_row")
        .join(sums, "_row", "left")
        .select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links",
            F.coalesce("n_best", F.lit(0)).cast("bigint").alias("n_best"),
            F.coalesce("count_sum", F.lit(0)).cast("bigint").alias("count_sum"),
            "groups_sha256",
        )
    )

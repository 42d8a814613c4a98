"""A public word-level BPE tokenizer, asked once for each word instead of once for each text."""

from __future__ import annotations

import json
import os
from codecs import charmap_decode
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Words whose ids are remembered per Python worker.
REMEMBER = 300_000

#: ASCII marks that make one piece behind a word; an apostrophe may begin an ending instead.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Words of letters whose normal form and lower case are plain.
_LATIN = "^[a-zÀ-ÖØ-öø-ÿ]+$"
_BREAK = "\x01"
_NONE = np.zeros(0, np.uint16)


def _flags(answers: pa.Array) -> np.ndarray:
    return answers.to_numpy(zero_copy_only=False)


def _gathered(ids: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids at ``places`` one after the other, and how many each has."""
    size = sizes[places]
    start = (np.cumsum(sizes) - sizes)[places]
    start -= np.cumsum(size) - size
    return ids[np.repeat(start, size) + np.arange(size.sum())], size


def _byte_alphabet() -> str:
    """How byte-level BPE writes bytes: visible Latin-1 characters stay, others move up from 256."""
    moved = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    place = {b: 256 + i for i, b in enumerate(moved)}
    return "".join(chr(place.get(b, b)) for b in range(256))


class WordEncoder:
    """``encode(texts)``: ids of whole texts as little-endian 16-bit numbers.

    White space ends every piece of this tokenizer, so a text's ids are those
    of its words one after the other. Words of letters and marks go straight to
    the library's BPE model; all others through its whole pipeline. Special
    strings in a text are ordinary text.
    """

    def __init__(self, spec: str, remember: int = REMEMBER):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.whole = Tokenizer.from_str(spec)
        self.whole.encode_special_tokens = True
        lean = json.loads(spec)
        if self.whole.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        lean |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.lean = Tokenizer.from_str(json.dumps(lean))
        suffix = lean["model"]["end_of_word_suffix"]
        self.last = np.zeros(self.whole.get_vocab_size(), bool)
        for token, i in lean["model"]["vocab"].items():
            self.last[i] = token.endswith(suffix)
        # A space parts the pieces of a line; no piece holds one.
        alphabet = _byte_alphabet()
        self.visible = alphabet[:32] + " " + alphabet[33:]
        self.remember = remember
        # The place of each word; how many ids each place has, and the ids themselves, in that order.
        self.known: dict[bytes, int] = {b"": 0}
        self.sizes, self.ids = np.zeros(1, np.int64), _NONE
        [mark] = self.whole.encode(_BREAK, add_special_tokens=False).ids
        self.mark = mark

    def _pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and how many of each: every one ends with the one id that closes a word."""
        lines = [
            charmap_decode(b" ".join(pieces[i : i + 500]), "strict", self.visible)[0]
            for i in range(0, len(pieces), 500)
        ]
        ids = np.concatenate(
            [_NONE, *(np.array(e.ids, np.uint16) for e in self.lean.encode_batch_fast(lines, add_special_tokens=False))]
        )
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(pieces):
            raise ValueError("a piece does not end with one closing id")
        return ids, np.diff(ends, prepend=0)

    def _odd(self, words: list[str]) -> list[np.ndarray]:
        """Ids of words that need the whole pipeline, split at a mark that none of them holds."""
        ids = [
            np.array(e.ids, np.uint16)
            for e in self.whole.encode_batch_fast(
                [f" {_BREAK} ".join(words[i : i + 200]) for i in range(0, len(words), 200)],
                add_special_tokens=False,
            )
        ]
        found = []
        for line in ids:
            cuts = np.flatnonzero(line == self.mark)
            found.extend(line[a:b] for a, b in zip(np.append(-1, cuts) + 1, np.append(cuts, len(line))))
        return found

    def _learn(self, words: list[bytes]) -> None:
        """Remember the ids of new words, whose ASCII letters are in lower case."""
        whole = pa.array(words, pa.large_binary()).cast(pa.large_string())
        stems = pc.ascii_rtrim(whole, characters=_MARKS)
        plain = _flags(pc.ascii_is_alpha(stems)) | _flags(pc.equal(stems, ""))
        rest = np.flatnonzero(~plain)
        latin = rest[_flags(pc.match_substring_regex(stems.take(rest), _LATIN))]
        stemmed, tailed = np.flatnonzero(plain), _flags(pc.less(pc.binary_length(stems), pc.binary_length(whole)))
        plain[latin] = True
        tailed = np.flatnonzero(tailed & plain)
        cut = pc.binary_length(stems).take(tailed).to_pylist()
        tails = [words[i][n:] for i, n in zip(tailed.tolist(), cut)]
        # Each piece once; a word is a stem, marks or both.
        parts = pa.chunked_array(
            [stems.take(stemmed), pc.utf8_lower(stems.take(latin)), pa.array(tails, pa.large_binary()).cast(pa.large_string())]
        )
        parts = parts.combine_chunks().dictionary_encode()
        pieces = parts.dictionary.cast(pa.large_binary()).to_pylist()
        place = np.array([self.known.get(p, -1) for p in pieces], np.int64)
        new = np.flatnonzero(place < 0)
        ids, sizes = self._pieces([pieces[i] for i in new.tolist()])
        place[new] = len(self.sizes) + np.arange(len(new))
        # Behind the words known: the new pieces, then the odd words.
        odd = np.flatnonzero(~plain)
        texts = [words[i].decode() for i in odd.tolist()]
        others = self._odd([t for t in texts if _BREAK not in t])[::-1]
        others = [
            np.array(self.whole.encode(t, add_special_tokens=False).ids, np.uint16) if _BREAK in t else others.pop()
            for t in texts
        ]
        table = np.concatenate([self.ids, ids, *others])
        lengths = np.concatenate([self.sizes, sizes, np.array(list(map(len, others)), np.int64)])
        # Two places a word, the second of which is empty without marks.
        both = np.zeros((len(words), 2), np.int64)
        at = place[parts.indices.to_numpy()]
        both[np.concatenate([stemmed, latin]), 0] = at[: len(stemmed) + len(latin)]
        both[tailed, 1] = at[len(stemmed) + len(latin) :]
        both[odd, 0] = len(self.sizes) + len(new) + np.arange(len(odd))
        found, sizes = _gathered(table, lengths, both.ravel())
        self.known.update(zip(words, range(len(self.sizes), len(self.sizes) + len(words))))
        self.ids = np.concatenate([self.ids, found])
        self.sizes = np.concatenate([self.sizes, sizes.reshape(-1, 2).sum(1)])

    def _forget(self, words: list[bytes]) -> None:
        """Of the words known, only these stay known."""
        stay = [b"", *(w for w in words if w and w in self.known)]
        self.ids, self.sizes = _gathered(self.ids, self.sizes, np.array([self.known[w] for w in stay], np.int64))
        self.known = dict(zip(stay, range(len(stay))))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        # Ids do not tell upper from lower case. White space at the ends of a text gives an empty word.
        lines = pa.array([t.lower() for t in texts], pa.large_binary()).cast(pa.large_string())
        lines = pc.ascii_split_whitespace(lines)
        occurring = lines.flatten().dictionary_encode()
        words = occurring.dictionary.cast(pa.large_binary()).to_pylist()
        new = list(filterfalse(self.known.__contains__, words))
        if len(self.known) - 1 + len(new) > self.remember:
            # What these texts hold stays known.
            self._forget(words)
        self._learn(new)
        place = np.array([self.known[w] for w in words], np.int64)
        ids, sizes = _gathered(self.ids, self.sizes, place[occurring.indices.to_numpy()])
        ends = 2 * np.append(0, np.cumsum(sizes))[lines.offsets.to_numpy()]
        raw = ids.astype("<u2", copy=False).tobytes()
        return [raw[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]


@lru_cache(maxsize=1)
def encoder(spec: str) -> WordEncoder:
    return WordEncoder(spec)


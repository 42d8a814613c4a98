"""Re-Pair grammar compression of a block of token ids, with numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Ids below are tokens, ids from here on are rules; all symbols fit 16 bits.
FIRST_RULE = 49_408
PAIRS_A_ROUND, LEAST = 2_048, 12

_BUCKETS = 18


@dataclass(frozen=True)
class Grammar:
    rules: np.ndarray  # (rules, 2) uint16: what each nonterminal stands for
    lengths: np.ndarray  # uint32: tokens that each nonterminal expands to
    symbols: np.ndarray  # uint16
    counts: np.ndarray  # uint32: symbols of each document, in order


def _keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left.astype(np.uint32) << np.uint32(16) | right


def _heavy(key: np.ndarray, least: int) -> np.ndarray:
    """Whether each key may occur ``least`` times; a hashed count leaves out most others."""
    bucket = ((key * np.uint32(0x9E3779B1)) >> np.uint32(32 - _BUCKETS)).astype(np.intp)
    return (np.bincount(bucket, minlength=1 << _BUCKETS) >= least)[bucket]


def _overlapping(at: np.ndarray, left: np.ndarray, right: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Which pairs of equal symbols overlap the one before, taken from the left of each run. ``at`` ascends."""
    over = np.zeros(len(at), bool)
    equal = np.flatnonzero(left == right)
    if len(equal):
        starts = np.ones(len(equal), bool)
        starts[1:] = (after[at[equal[:-1]]] != at[equal[1:]]) | (left[equal[1:]] != left[equal[:-1]])
        place = np.arange(len(equal))
        over[equal] = (place - np.maximum.accumulate(np.where(starts, place, 0))) % 2 == 1
    return over


def _chosen(keys: np.ndarray, counts: np.ndarray, most: int) -> list[tuple[int, int]]:
    """The most frequent pairs that can be replaced in one pass.

    No symbol is the first of one pair and the second of another, and one that
    is paired with itself is in no other pair, so no two occurrences overlap;
    pairs left out now stand again in the next round.
    """
    side: dict[int, int] = {}
    pairs = []
    for key in keys[np.lexsort((keys, -counts))].tolist():
        a, b = key >> 16, key & 0xFFFF
        if a == b:
            if a in side:
                continue
            side[a] = 2
        elif side.get(a, 0) or side.get(b, 1) != 1:
            continue
        else:
            side[a], side[b] = 0, 1
        pairs.append((a, b))
        if len(pairs) == most:
            break
    return pairs


def compress(ids: np.ndarray, counts: np.ndarray, most: int = PAIRS_A_ROUND, least: int = LEAST) -> Grammar:
    """Replace frequent pairs until none occurs ``least`` times or all rules are used.

    ``counts`` are the ids of each document; no pair crosses them. A pair gains
    occurrences only in the round that makes one of its symbols: after the
    first round, only places of new symbols and of pairs left out are looked at.
    """
    n = len(ids)
    symbols = ids.astype(np.uint16)
    last = np.zeros(n, bool)
    ends = np.cumsum(counts)
    last[ends[counts > 0] - 1] = True
    wide = np.int32 if n < 1 << 31 else np.int64
    # The places of the symbols after and before each, and whether a place still holds one.
    after, before = np.arange(1, n + 1, dtype=wide), np.arange(-1, n, dtype=wide)
    alive = np.ones(n, bool)
    rules: list[tuple[int, int]] = []
    lengths: list[int] = []
    length = np.ones(1 << 16, np.uint32)
    at = np.flatnonzero(~last).astype(wide)
    while len(at) and (room := min(most, (1 << 16) - FIRST_RULE - len(rules))):
        left, right = symbols[at], symbols[after[at]]
        key = _keys(left, right)
        over = _overlapping(at, left, right, after)
        if len(at) > 1 << 16:
            heavy = _heavy(key, least)
            at, key, over = at[heavy], key[heavy], over[heavy]
        found, times = np.unique(key[~over] if over.any() else key, return_counts=True)
        often = times >= least
        pairs = _chosen(found[often], times[often], room)
        if not pairs:
            break
        a, b = np.array(pairs, np.uint32).T
        key_of = a << np.uint32(16) | b
        order = np.argsort(key_of)
        name = (FIRST_RULE + len(rules) + np.arange(len(pairs))).astype(np.uint16)
        length[name] = length[a] + length[b]
        rules.extend(pairs)
        lengths.extend(length[name].tolist())
        first, second = np.zeros(1 << 16, bool), np.zeros(1 << 16, bool)
        first[a], second[b] = True, True
        may = np.flatnonzero(first[key >> np.uint32(16)] & second[key & np.uint32(0xFFFF)] & ~over)
        wanted = key[may]
        place = np.minimum(np.searchsorted(key_of[order], wanted), len(pairs) - 1)
        hit = key_of[order][place] == wanted
        may, place = may[hit], place[hit]
        made = at[may]
        gone = after[made]
        symbols[made] = name[order][place]
        last[made] = last[gone]
        alive[gone] = False
        after[made] = after[gone]
        before[after[made]] = made
        # Places to look at next: of pairs often enough that were left out, and around new symbols.
        rest = np.ones(len(at), bool)
        rest[may] = False
        at = at[rest]
        near = before[made]
        look = np.concatenate([at, made, near[near >= 0]])
        look = look[alive[look] & ~last[look]]
        if len(look) > n >> 4:
            marked = np.zeros(n, bool)
            marked[look] = True
            at = np.flatnonzero(marked).astype(wide)
        else:
            look.sort()  # much cheaper than np.unique, which hashes first
            once = np.ones(len(look), bool)
            once[1:] = look[1:] != look[:-1]
            at = look[once]
    last, symbols = last[alive], symbols[alive]
    ends = np.flatnonzero(last) + 1
    sizes = np.zeros(len(counts), np.uint32)
    sizes[counts > 0] = np.diff(np.append(0, ends))
    return Grammar(
        np.array(rules, np.uint16).reshape(-1, 2), np.array(lengths, np.uint32), symbols, sizes
    )


class Expander:
    """Expands symbols of one grammar; rules are spelled out once."""

    def __init__(self, rules: np.ndarray, lengths: np.ndarray):
        self.length = np.ones(1 << 16, np.int64)
        self.length[FIRST_RULE : FIRST_RULE + len(rules)] = lengths
        self.start = np.arange(1 << 16, dtype=np.int64)
        spelled = [np.arange(1 << 16, dtype=np.uint16)]
        size = 1 << 16
        parts: list[np.ndarray] = []
        for i, (a, b) in enumerate(rules.tolist()):
            part = np.concatenate(
                [np.array([s], np.uint16) if s < FIRST_RULE else parts[s - FIRST_RULE] for s in (a, b)]
            )
            parts.append(part)
            self.start[FIRST_RULE + i] = size
            size += len(part)
        self.spelled = np.concatenate([*spelled, *parts])

    def __call__(self, symbols: np.ndarray) -> np.ndarray:
        length = self.length[symbols]
        total = int(length.sum())
        before = np.cumsum(length) - length
        return self.spelled[np.repeat(self.start[symbols] - before, length) + np.arange(total)]

    def token(self, symbols: np.ndarray, position: int) -> int:
        """The token at ``position``, found by the lengths alone; one symbol is expanded."""
        upto = np.cumsum(self.length[symbols])
        i = int(np.searchsorted(upto, position, side="right"))
        return int(self(symbols[i : i + 1])[position - (int(upto[i - 1]) if i else 0)])

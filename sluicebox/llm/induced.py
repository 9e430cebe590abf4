"""Induced suffix sorting with queues that move to disk, for one shard of joined texts.

A suffix is sorted by its first character and the place of the suffix behind it, which is known already when suffixes are
taken in order. Two passes do that: from the sorted leftmost suffixes of type S (LMS) all suffixes of type L, and from
those all of type S. The LMS suffixes themselves are sorted by the names of the stretches between them: each turn compares
twice as many names, of the suffixes that still have equals (Larsson and Sadakane), as passes over texts of many names would
move on by a few suffixes at a time.
A pass keeps its pending suffix tuples in a priority queue of sorted runs; large runs lie in files of the task's scratch
folder, as Spark's own spills do, and are read in blocks. Tuples are taken in batches as long as none that is still to be
pushed could come before them. Common-prefix lengths go through the passes with the suffixes: the prefix that two induced
neighbours share is one more than the least among all suffixes between their sources.
"""

from __future__ import annotations

import tempfile

import numpy as np

MEMORY_ENTRIES = 4_000_000  # a longer run goes to disk
NOTHING = np.int64(1 << 62)
NO_PREFIX = np.zeros(0, np.int64)
BYTE_FAR, FAR = 8_000, 1 << 40  # beyond all keys; doubled, they still fit their types
LETTER_BITS, PACKED = 10, 6  # of a character with its type; characters in one key


def kept(array: np.ndarray, folder: str) -> np.ndarray:
    """The array, or a file of it where it is long; the file has no name, so it goes with the last reader."""
    if len(array) <= MEMORY_ENTRIES:
        return array
    file = tempfile.TemporaryFile(dir=folder or None)
    array.tofile(file)
    return np.memmap(file, array.dtype, "r", shape=array.shape)


class RunQueue:
    """A priority queue of tuples (key, position, common prefix): sorted runs, the older one first among equal keys."""

    def __init__(self, folder: str, kind: np.dtype) -> None:
        self.folder, self.kind = folder, kind
        self.runs: list[list[np.ndarray]] = []

    def push(self, keys: np.ndarray, positions: np.ndarray, prefixes: np.ndarray) -> None:
        """A run sorted by key is added; runs of similar length merge, so their number stays logarithmic."""
        run = [keys, positions, prefixes]
        while self.runs and len(self.runs[-1][0]) <= 4 * len(run[0]):
            older = self.runs.pop()
            joined = [np.concatenate(x) for x in zip(older, run, strict=True)]
            order = np.argsort(joined[0], kind="stable")
            run = [x[order] if len(x) else x for x in joined]
        self.runs.append([kept(x, self.folder) for x in run])

    def first(self, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The first tuples in order, with the run of each; they stay until ``drop``."""
        heads = [[x[:most] for x in run] for run in self.runs]
        if not heads:
            none = np.zeros(0, np.int64)
            return np.zeros(0, self.kind), none, none, none
        if len(heads) == 1:
            return *heads[0], np.zeros(len(heads[0][0]), np.int64)
        keys, positions, prefixes = (np.concatenate(x) for x in zip(*heads, strict=True))
        source = np.repeat(np.arange(len(heads)), [len(h[0]) for h in heads])
        order = np.argsort(keys, kind="stable")[:most]
        return keys[order], positions[order], prefixes[order] if len(prefixes) else prefixes, source[order]

    def drop(self, source: np.ndarray) -> None:
        used = np.bincount(source, minlength=len(self.runs))
        cut = [[x[n:] for x in run] if n else run for run, n in zip(self.runs, used.tolist(), strict=True)]
        self.runs = [run for run in cut if len(run[0])]


def range_minimum(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of values[low..high] for each pair, from minima over powers of two."""
    span = high - low + 1
    level = np.frexp(span.astype(float))[1] - 1
    out, table = np.empty(len(low), values.dtype), values
    for k in range(int(level.max(initial=0)) + 1):
        here = level == k
        if here.any():
            out[here] = np.minimum(table[low[here]], table[high[here] - (1 << k) + 1])
        if len(table) > 1 << k:
            table = np.minimum(table[: len(table) - (1 << k)], table[1 << k :])
    return out


def induce(
    stream: np.ndarray, shared: np.ndarray | None, key: np.ndarray, pushes: np.ndarray, alike: np.ndarray | None, folder: str
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass: all suffixes reached from the sorted ``stream``, merged with it.

    key: sort key of each position, ascending. pushes[p]: whether the suffix before p belongs to this pass. shared: common
    prefix of each stream entry with the one before. alike: length of the run of equal characters at each position.
    Returns positions, whether each came from the queue, and common prefixes (none without ``shared``).
    """
    queue, carry = RunQueue(folder, key.dtype), None
    with_prefix = shared is not None
    if with_prefix:
        carry = np.zeros(int(key.max()) - int(key.min()) + 1, np.int64)
        lowest = int(key.min())
    out_position, out_queue, out_prefix = [], [], []
    far = key.dtype.type(BYTE_FAR if key.dtype == np.int16 else FAR)  # short keys are sorted by their digits
    at, most = 0, 1024
    last_key, last_position, last_queue = None, 0, False
    while True:
        qk, qp, qx, source = queue.first(most)
        sp = stream[at : at + most]
        if not len(qk) and not len(sp):
            break
        sk = key[sp]
        # What one side has beyond the part that was read bounds what may be taken from the other; doubled keys.
        bound = NOTHING
        if len(qk) == most:
            bound = min(bound, 2 * int(qk[-1]))
        if len(sp) == most and at + most < len(stream):
            bound = min(bound, 2 * int(sk[-1]) + 1)
        keys = np.concatenate([qk * 2, sk * 2 + 1])  # at equal keys the queue comes first
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        if bound < NOTHING:
            keys = keys[: max(1, int(np.searchsorted(keys, bound, "right")))]
            order = order[: len(keys)]
        positions = np.concatenate([qp, sp])[order]
        from_queue = order < len(qk)
        pushing = pushes[positions]  # never at the first position
        pushed = np.where(pushing, key[positions - 1], far)
        soonest = np.minimum.accumulate(pushed)
        unsafe = np.flatnonzero(keys[1:] > 2 * soonest[:-1])
        take = int(unsafe[0]) + 1 if len(unsafe) else len(keys)
        most = int(min(max(1024, 2 * take), 1 << 18))
        if take < len(keys):
            order, positions, from_queue, keys, pushing, pushed = (x[:take] for x in (order, positions, from_queue, keys, pushing, pushed))
        prefix = NO_PREFIX
        char = keys >> 1
        if with_prefix:
            prefix = np.concatenate([qx, shared[at : at + len(sp)]])[order]
            before_char = np.concatenate([[last_key if last_key is not None else -NOTHING], char[:-1].astype(np.int64)])
            before_queue = np.concatenate([[last_queue], from_queue[:-1]])
            before_position = np.concatenate([[last_position], positions[:-1]])
            turn = before_queue & ~from_queue
            prefix = np.where(turn, np.minimum(alike[before_position], alike[positions]), prefix)
            prefix = np.where(before_char != char, 0, prefix)
        used = int(from_queue.sum())
        if used:
            queue.drop(source[order[from_queue]])
        at += take - used
        last_key, last_position, last_queue = int(char[-1]), int(positions[-1]), bool(from_queue[-1])
        index = np.flatnonzero(pushing)
        if len(index):
            by = np.argsort(pushed[index], kind="stable")
            index = index[by]
            new_key = pushed[index]
            new_prefix = np.zeros(len(index), np.int64) if with_prefix else NO_PREFIX
        if with_prefix:
            least = int(prefix.min())
            if len(index):
                slot = new_key.astype(np.int64) - lowest
                same = np.flatnonzero(slot[1:] == slot[:-1]) + 1
                new_prefix[same] = 1 + range_minimum(prefix, index[same - 1] + 1, index[same])
                heads = np.setdiff1d(np.arange(len(index)), same, assume_unique=True)
                to_here = np.minimum.accumulate(prefix)
                new_prefix[heads] = 1 + np.minimum(carry[slot[heads]], to_here[index[heads]])
                carry = np.minimum(carry, least)
                tails = np.concatenate([heads[1:] - 1, [len(index) - 1]])
                to_end = np.minimum.accumulate(prefix[::-1])[::-1]
                end = index[tails]
                carry[slot[tails]] = np.where(end + 1 < take, to_end[np.minimum(end + 1, take - 1)], NOTHING // 4)
            else:
                carry = np.minimum(carry, least)
        if len(index):
            queue.push(new_key, positions[index] - 1, new_prefix)
        out_position.append(positions)
        out_queue.append(from_queue)
        out_prefix.append(prefix)
    return tuple(kept(np.concatenate(x), folder) for x in (out_position, out_queue, out_prefix))


def types(text: np.ndarray) -> np.ndarray:
    """True for suffixes of type S; the last character is the unique least one."""
    n = len(text)
    differs = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    rising = np.append(text[differs[:-1]] < text[differs[:-1] + 1], True)
    return rising[np.searchsorted(differs, np.arange(n))]


def equal_runs(text: np.ndarray) -> np.ndarray:
    """Length of the run of equal characters that starts at each position."""
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), len(text) - 1)
    return ends[np.searchsorted(ends, np.arange(len(text)))] - np.arange(len(text)) + 1


def _passes(text: np.ndarray, s: np.ndarray, lms: np.ndarray, shared: np.ndarray | None, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in descending order but the last character's, from the sorted LMS suffixes; with common prefixes."""
    alike = equal_runs(text) if shared is not None else None
    before_l = np.concatenate([[False], ~s[:-1]])
    before_s = np.concatenate([[False], s[:-1]])
    positions, queued, prefix = induce(lms, shared, text, before_l, alike, folder)
    falling = positions[queued][::-1]
    shared_falling = np.concatenate([[0], prefix[queued][1:][::-1]]) if shared is not None else None
    positions, _, prefix = induce(falling, shared_falling, -text, before_s, alike, folder)
    return positions, prefix


def _ranked(lower: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of entries that lie sorted by a lower rank and a key, and whether each has equals. A rank counts all lesser entries."""
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (lower[1:] != lower[:-1])
    start = np.flatnonzero(new)
    length = np.diff(start, append=len(key))
    opens = np.ones(len(start), bool)  # the first of a lower rank keeps that rank
    opens[1:] = lower[start[1:]] != lower[start[:-1]]
    opened = start[np.maximum.accumulate(np.where(opens, np.arange(len(start)), 0))]
    return np.repeat(lower[start] + start - opened, length), np.repeat(length > 1, length)


def _stretch_names(text: np.ndarray, s: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Ranks of the stretches from each LMS position to the next one, the last character's first; equal stretches have one rank.

    Characters are compared with their types, ``PACKED`` at a time, until a stretch is told apart or ends. With its types no
    stretch begins another one, as the other would end there as well.
    """
    letters = np.concatenate([text * 2 + s, np.zeros(PACKED, text.dtype)])
    end = np.append(lms[1:], lms[-1])
    names, done = np.empty(len(lms), np.int64), 0
    live, lower = np.arange(len(lms)), np.zeros(len(lms), np.int64)
    while len(live):
        at, size = lms[live] + done, end[live] - lms[live] + 1 - done
        key = np.zeros(len(live), np.int64)
        for k in range(PACKED):
            key = key << LETTER_BITS | np.where(k < size, letters[at + k], 0)
        order = np.argsort(key, kind="stable")
        if done:
            order = order[np.argsort(lower[order], kind="stable")]
        lower, several = _ranked(lower[order], key[order])
        live = live[order]
        names[live] = lower
        done += PACKED
        several &= size[order] > PACKED
        live, lower = live[several], lower[several]
    return names


def sorted_lms(text: np.ndarray, s: np.ndarray) -> np.ndarray:
    """The LMS suffixes in order, the last character's first: by names of LMS stretches, and what follows them where names repeat."""
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    return lms[_suffix_order(_stretch_names(text, s, lms))]


def _suffix_order(names: np.ndarray) -> np.ndarray:
    """All suffixes of a text of names in order; its last name is the unique least one.

    Those alike in ``told`` names are told apart by the ranks ``told`` places behind them, which reach as far again. No such
    place is beyond the end, as the last name is unique.
    """
    live = np.argsort(names, kind="stable")
    rank, lower, told = np.empty(len(names), np.int64), np.zeros(len(names), np.int64), 0
    key = names[live]
    while len(live):
        lower, several = _ranked(lower, key)
        rank[live] = lower
        live, lower = live[several], lower[several]
        told = max(1, 2 * told)
        key = lower * len(names) + rank[live + told]
        order = np.argsort(key, kind="stable")
        live, lower, key = live[order], lower[order], key[order]
    out = np.empty(len(names), np.int64)
    out[rank] = np.arange(len(names))
    return out


def common_prefixes(raw: np.ndarray, left: np.ndarray, right: np.ndarray, most: int) -> np.ndarray:
    """Common prefix lengths of pairs of positions, up to ``most``, eight bytes at a time."""
    padded = np.concatenate([raw, np.zeros(most + 16, np.uint8)])
    words = np.ndarray((len(padded) - 7,), "<u8", padded.data, strides=(1,))
    out, live = np.full(len(left), most, np.int64), np.arange(len(left))
    for k in range(0, most, 8):
        differing = words[left[live] + k] ^ words[right[live] + k]
        split = differing != 0
        if split.any():
            low = differing[split] & (~differing[split] + np.uint64(1))
            out[live[split]] = np.minimum(k + (np.log2(low.astype(float)) // 8).astype(np.int64), most)
            live = live[~split]
        if not len(live):
            break
    return out


def suffixes_with_prefixes(pieces: list[bytes], most: int, folder: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes of the joined pieces in descending order, and the common prefix of each with the one before.

    Common prefixes are exact up to ``most`` within a piece. Also returns the start of each piece in the joined text.
    """
    sizes = np.array([len(p) + 1 for p in pieces], np.int64)
    raw = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    starts = np.cumsum(sizes) - sizes
    text = raw.astype(np.int16) + np.int16(2)
    text[starts + sizes - 1] = 1
    text = np.append(text, np.int16(0))
    s = types(text)
    lms = sorted_lms(text, s)
    # The joint of two pieces counts as a character here; prefixes across it only concern suffixes shorter than ``most``.
    shared = np.concatenate([[0, 0], common_prefixes(raw, lms[1:-1], lms[2:], most)])[: len(lms)]
    falling, prefix = _passes(text, s, lms, shared, folder)
    return falling, prefix, starts

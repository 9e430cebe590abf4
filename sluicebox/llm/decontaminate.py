"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are lower-cased and every run of characters other than letters and digits becomes one blank. An item of n
characters may occur with k = n * ``ERROR_SHARE`` edits. By the q-gram lemma such an occurrence shares at least
n - q + 1 - k q of the item's q-grams, all on diagonals that differ by k at most, hence inside one of the overlapping
bands of 2 k + 2 diagonals that start every k + 1. Counted are the text positions of a band whose q-gram the item has there:
each q-gram that an occurrence keeps has a position of its own. Bands with fewer are dropped; the others are verified by
an alignment within the band's diagonals, which counts edits exactly up to the budget.

The benchmark goes to all tasks in blocks of at most ``BLOCK_BYTES`` text, one pass over the documents per block, so a
large benchmark takes more passes, not more memory. Documents are never shuffled or gathered.

Defined results: null and empty texts hold nothing; items without letters or digits, or null ones, match nothing; items
shorter than q need an exact occurrence of the whole normalised item as words; equal items are reported each; repeated
rows are reported each; several occurrences of an item in a text give the one with the fewest edits, the first of equals.
Whole texts are read. Other columns are ignored by ``find_leaks`` and kept by ``drop_leaking``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import whole_text

Q = 8
ERROR_SHARE = 0.1
BLOCK_BYTES = 4_000_000
CHUNK_CHARS = 500_000
STRETCH = 1_000_000  # text positions that are looked up at a time
HITS = 500_000  # pairs of a position and a q-gram of an item that are counted at a time, or those of one position
CELLS = 100_000  # item characters that are aligned at a time; each stands for up to 1.4 window characters
BITS = 22
FIELD = np.uint64(0x9E3779B97F4A7C15)
NOT_WORD = re.compile(r"[\W_]+")


def normal(text: str) -> str:
    return NOT_WORD.sub(" ", text.lower()).strip()


def grams(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each q characters; equal q-grams have equal hashes, and alignment removes chance matches."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    n = len(codes) - Q + 1
    out = np.zeros(n, np.uint64)
    wide = codes.astype(np.uint64)
    for i in range(Q):
        out *= FIELD
        out += wide[i : i + n]
    out ^= out >> np.uint64(29)
    out *= FIELD
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Block:
    """A block of the benchmark: the sorted q-grams of its items with their places, and a table of bits to reject others."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        self.codes = [_codes(t) for t in self.texts]
        self.budget = np.array([min(int(len(c) * ERROR_SHARE), max(0, (len(c) - Q) // Q)) for c in self.codes], np.int64)
        self.least = np.array([max(1, len(c) - Q + 1 - k * Q) for c, k in zip(self.codes, self.budget, strict=True)], np.int64)
        self.short = [i for i, c in enumerate(self.codes) if len(c) < Q]
        hashed = [grams(c) for c in self.codes]
        sizes = [len(h) for h in hashed]
        every = np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        every = every[order]
        item = np.repeat(np.arange(len(items)), sizes)[order]
        place = (np.arange(len(every)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[order] if sizes else np.zeros(0, np.int64)
        # A group is a q-gram of an item with all its places, which ascend.
        new = np.ones(len(every), bool)
        new[1:] = (every[1:] != every[:-1]) | (item[1:] != item[:-1])
        first = np.flatnonzero(new)
        self.longest = max(map(len, self.codes), default=0)
        self.gram, self.item = every[first], item[first]
        self.lowest, self.highest = place[first], place[np.append(first[1:], len(every)) - 1] if len(every) else place
        self.spots = (np.cumsum(new) - 1) * (self.longest + 2) + place + 1
        self.bits = np.zeros(1 << BITS, bool)
        self.bits[(every >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def candidates(self, codes: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Document number, item and band start (diagonal in the joined text) where enough q-grams are shared.

        Positions are read in stretches of bounded hits. Counted are text positions per band, however many places of the
        item they meet, so a repeated character costs a bounded number of rows. Only bands that later positions can still
        reach stay open from one stretch to the next.
        """
        span = len(codes) + 2 * self.longest + 2
        key, docs, count = np.zeros((3, 0), np.int64)
        for start, where, group in self._hits(codes):
            shut = start - self.longest  # a band that ends here or earlier meets no item any more
            done = self._ends(key, span) <= shut
            yield self._shared_enough(key[done], docs[done], count[done], span)
            k, d = self._bands(where, group, ends, span)
            key, docs, count = _tally(np.concatenate([key[~done], k]), np.concatenate([docs[~done], d]), np.concatenate([count[~done], np.ones_like(k)]))
        yield self._shared_enough(key, docs, count, span)

    def _ends(self, key: np.ndarray, span: int) -> np.ndarray:
        """The first diagonal behind each band."""
        return (key % span + 1) * (self.budget[key // span] + 1) - self.longest

    def _shared_enough(self, key: np.ndarray, docs: np.ndarray, count: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        good = count >= self.least[key // span]
        item, band = key[good] // span, key[good] % span - 1
        return docs[good], item, band * (self.budget[item] + 1) - self.longest

    def _hits(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Stretches of positions and the groups they meet, with the first position each stretch may hold."""
        for begin in range(0, len(codes), STRETCH):
            hashed = grams(codes[begin : begin + STRETCH + Q - 1])
            maybe = np.flatnonzero(self.bits[(hashed >> np.uint64(64 - BITS)).astype(np.int64)])
            lo = np.searchsorted(self.gram, hashed[maybe], "left")
            n = np.searchsorted(self.gram, hashed[maybe], "right") - lo
            maybe, lo, n = maybe[n > 0] + begin, lo[n > 0], n[n > 0]
            total = np.cumsum(n)
            cuts = np.unique(np.searchsorted(total, np.arange(HITS, total[-1] + HITS, HITS), "right")) if len(n) else []
            left = 0
            for right in dict.fromkeys([*cuts, len(n)]):
                if right > left:
                    at, sizes = lo[left:right], n[left:right]
                    step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    yield int(maybe[left]), np.repeat(maybe[left:right], sizes), np.repeat(at, sizes) + step
                    left = right

    def _bands(self, where: np.ndarray, group: np.ndarray, ends: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys (item and band) and documents of the bands in which a position meets a place of its group, each once."""
        item = self.item[group]
        step = self.budget[item] + 1
        # Diagonals can be negative near the first text's start; one shift keeps all bands countable.
        shifted = where + self.longest
        lo = (shifted - self.highest[group]) // step
        n = (shifted - self.lowest[group]) // step - lo + 1
        row = np.repeat(np.arange(len(n)), n)
        cell = np.repeat(lo, n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        # Cell c holds the places from shifted - (c + 1) * step + 1 to shifted - c * step.
        above = shifted[row] - cell * step[row]
        base = group[row] * (self.longest + 2) + 1
        least, most = np.clip(above - step[row], -1, self.longest), np.clip(above, -1, self.longest)
        met = np.searchsorted(self.spots, base + most, "right") > np.searchsorted(self.spots, base + least, "right")
        row, cell = row[met], cell[met]
        # A cell belongs to the band that starts here and to the one before, which the cell before may have given already.
        again = np.zeros(len(row), bool)
        again[1:] = (row[1:] == row[:-1]) & (cell[1:] == cell[:-1] + 1)
        band = np.concatenate([cell + 1, cell[~again]])  # numbered from 1, as the first has one before it
        row = np.concatenate([row, row[~again]])
        return item[row] * span + band, np.searchsorted(ends, where[row], "right")


def _tally(key: np.ndarray, docs: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts added up by key and document."""
    if not len(key):
        return key, docs, count
    order = np.lexsort((docs, key))
    key, docs, count = key[order], docs[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (docs[1:] != docs[:-1])]))
    return key[first], docs[first], np.add.reduceat(count, first)


def _parts(lengths: np.ndarray) -> Iterator[slice]:
    """Slices of ascending lengths whose alignments take a bounded number of cells (one alignment at least)."""
    start = 0
    while start < len(lengths):
        fits = np.arange(1, len(lengths) - start + 1) * lengths[start:] <= CELLS
        stop = start + max(1, int(fits.argmin() if not fits.all() else len(fits)))
        yield slice(start, stop)
        start = stop


def banded_edits(items: list[np.ndarray], texts: list[np.ndarray], starts: np.ndarray, widths: np.ndarray, budgets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits of each whole item against a stretch of its text, within the diagonals start to start + width - 1, and
    the end of the first such stretch. All alignments of a batch advance one item character at a time."""
    cases, width, rows = len(items), int(widths.max()), max(map(len, items))
    letters = np.full((cases, rows), 0x110000, np.int64)
    window = np.full((cases, rows + width), 0x110001, np.int64)
    for i, (x, t) in enumerate(zip(items, texts, strict=True)):
        letters[i, : len(x)] = x
        a, b = int(starts[i]), int(starts[i]) + rows + width
        part = t[max(a, 0) : max(b, 0)]
        window[i, max(-a, 0) : max(-a, 0) + len(part)] = part
    lengths = np.array([len(x) for x in items])
    big, steps = 1 << 20, np.arange(width)
    outside = steps[None, :] >= widths[:, None]
    # Cell j of row r: r item characters against a stretch that ends before text position start + r + j.
    before_text = starts[:, None] + steps[None, :]
    size = np.array([len(t) for t in texts])[:, None]
    row = np.where((before_text < 0) | (before_text > size) | outside, big, 0)
    result, end = np.full(cases, big), np.zeros(cases, np.int64)
    for r in range(1, rows + 1):
        same = window[:, r - 1 : r - 1 + width] == letters[:, r - 1 : r]
        best = row + ~same
        best[:, :-1] = np.minimum(best[:, :-1], row[:, 1:] + 1)
        position = before_text + r
        best[(position < 0) | (position > size) | outside] = big
        row = np.minimum.accumulate(best - steps, axis=1) + steps
        row[(position > size) | outside] = big
        done = lengths == r
        if done.any():
            result[done] = row[done].min(1)
            end[done] = (starts + r + row.argmin(1))[done]
    return np.where(result <= budgets, result, -1), end


def _leaks_in(texts: list[str], block: Block) -> Iterator[tuple[int, int, int, int]]:
    """Text number, item number, edits and end for each item that a text holds."""
    normals = [normal(t) for t in texts]
    for i, t in enumerate(normals):
        for j in block.short:
            if block.texts[j] and f" {block.texts[j]} " in f" {t} ":
                yield i, j, 0, f" {t} ".index(f" {block.texts[j]} ") + len(block.texts[j])
    sizes = np.array([len(t) + 1 for t in normals])
    codes = _codes("\n".join(normals) + "\n")
    ends_of = np.cumsum(sizes)
    begins = ends_of - sizes
    best: dict[tuple[int, int], tuple[int, int]] = {}

    def improves(x: int, i: int, start: int) -> bool:
        """Whether an alignment from this diagonal on can still beat the one found: no edits are beaten by an earlier end."""
        edits, end = best.get((x, i), (1, 0))
        return edits > 0 or start + len(block.codes[i]) < end

    for docs, items, diagonals in block.candidates(codes, ends_of):
        lengths = np.array([len(block.codes[i]) for i in items], np.int64)
        order = np.argsort(lengths, kind="stable")
        for cut in _parts(lengths[order]):
            part = order[cut]
            budgets = block.budget[items[part]]
            # A match on any of the band's diagonals may drift by the budget to either side.
            starts = diagonals[part] - begins[docs[part]] - budgets
            open_ = np.array([improves(*case) for case in zip(docs[part].tolist(), items[part].tolist(), starts.tolist(), strict=True)], bool)
            part, budgets, starts = part[open_], budgets[open_], starts[open_]
            if not len(part):
                continue
            d, it = docs[part], items[part]
            views = [codes[begins[x] : begins[x] + sizes[x] - 1] for x in d]
            edits, ends = banded_edits([block.codes[i] for i in it], views, starts, 4 * budgets + 2, budgets)
            for x, i, e, end in zip(d.tolist(), it.tolist(), edits.tolist(), ends.tolist(), strict=True):
                if e >= 0 and (e, end) < best.get((x, i), (1 << 30, 0)):
                    best[x, i] = (e, end)
    for (x, i), (e, end) in best.items():
        yield x, i, e, end


def _chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_CHARS:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, texts[start:]


def benchmark_blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The benchmark in blocks of bounded size, read through the driver one block at a time."""
    items: list[tuple[int, str]] = []
    size = 0
    for row in benchmark.select("item_id", whole_text().alias("text")).orderBy("item_id", "text").toLocalIterator():
        text = normal(row["text"])
        if not text or row["item_id"] is None:
            continue
        if items and size + len(text) > BLOCK_BYTES:
            yield Block(items)
            items, size = [], 0
        items.append((row["item_id"], text))
        size += len(text)
    yield Block(items)


def find_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, edits and end (in the normalised text) of each item that a document holds."""
    kinds = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, item_id {benchmark.schema['item_id'].dataType.simpleString()}"
    rows = documents.select("doc_id", whole_text().alias("text"))

    def with_block(block: Block) -> DataFrame:
        shared = documents.sparkSession.sparkContext.broadcast(block)

        def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                ids = batch["doc_id"].tolist()
                for start, texts in _chunks(batch["text"].tolist()):
                    found = list(_leaks_in(texts, shared.value))
                    yield pd.DataFrame({
                        "doc_id": pd.Series([ids[start + x] for x, *_ in found], dtype=batch["doc_id"].dtype),
                        "item_id": [shared.value.ids[i] for _, i, _, _ in found],
                        "edits": [e for *_, e, _ in found],
                        "end": [end for *_, end in found],
                    })

        return rows.mapInPandas(compute, f"{kinds}, edits int, end long")

    parts = [with_block(b) for b in benchmark_blocks(benchmark)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def drop_leaking(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all columns; each text is judged by itself, row by row."""
    def free_of(block: Block) -> Column:
        shared = documents.sparkSession.sparkContext.broadcast(block)

        def clean(texts: pd.Series) -> pd.Series:
            good = np.ones(len(texts), bool)
            for start, part in _chunks(texts.tolist()):
                good[[start + x for x, *_ in _leaks_in(part, shared.value)]] = False
            return pd.Series(good)

        return F.pandas_udf(clean, "boolean")(whole_text())

    kept = documents
    for block in benchmark_blocks(benchmark):
        kept = kept.where(free_of(block))
    return kept

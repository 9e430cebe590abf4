"""Alignment of the tokens of two tokenizers: byte-level merges (A) and SentencePiece with byte fallback (B).

A sees a blank and the text, B the text, to which it adds a blank itself; so both spell the same bytes. Coarse cuts are the
character offsets of A and the spans of B. Where a token's span has as many bytes as the token itself, its end is the span's.
Tokens that share a character (its bytes fall to several tokens of A, or to byte pieces of B) are told apart by
their decoded bytes. Byte offsets where tokens of both end cut the text into groups; tokens whose bytes overlap are links.

No token of either reaches across a blank that follows a character other than white space (A: the pattern that splits its
input; B: checked over the vocabulary, else texts stay whole). Texts are cut there, each distinct unit is aligned once per task and
kept in a bounded table, and texts are put together from their units.

Counts of linked id pairs cover all documents. Each task counts the distinct pairs of its documents in parts of bounded size, Spark
adds them up. The commonest pairs, at most ``COMMON_PAIRS``, are looked up in the tasks; the others go through a join, in which no key can be
hot, as a pair that many documents hold is a common one.

Defined results: null and empty texts, and texts whose tokens of A or B do not spell them exactly (such as those
with a literal U+2581, which B takes for a blank), have no tokens: all zeros, and '' for the digest. Equal rows are each a
document. Texts are read whole. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from hashlib import sha256
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import whole_text, written

MARK = "▁"
LOOSE = re.compile(r"\s | $")  # where a blank is no cut by itself
UNITS_AT_ONCE, CHARACTERS_AT_ONCE = 20_000, 2_000_000
REMEMBERED_UNITS, REMEMBERED_LENGTH = 250_000, 64  # of each of two generations in a task process; longer units are not kept
PAIRS_AT_ONCE = 4_000_000
COMMON_PAIRS = 1_000_000  # of 17 bytes each, in every task


# An aligned unit: whether both spell it exactly, tokens of A, of B, groups, the groups as text, and the links as packed pair numbers.
Unit = tuple[bool, int, int, int, bytes, bytes]
LOSSY: Unit = (False, 0, 0, 0, b"", b"")
JOINED_UNITS = 50


def byte_alphabet() -> dict[str, int]:
    """The byte of each character of byte-level vocabularies: printable Latin-1 stands for itself, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers with the bytes of every token."""

    def __init__(self, path_a: str, path_b: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        names = {i: name for name, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.bytes_a = [bytes(alphabet[c] for c in names.get(i, "")) for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.size_b = len(pieces)
        self.kind = np.dtype(np.uint32 if len(self.bytes_a) * self.size_b < 2**32 else np.int64)
        self.length_a, self.length_b = (np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b))
        self.cut = not any(MARK in p.lstrip(MARK) for p in pieces)

    def units(self, text: str) -> list[str]:
        """The text in units; each stands behind a blank that is not part of it."""
        if not self.cut:
            return [text]
        pieces = text.split(" ")
        if not LOOSE.search(f" {text}"):
            return pieces
        found, end = [pieces[0]], len(pieces) - 1
        for n, piece in enumerate(pieces[1:], 1):
            before = found[-1]
            if before and not before[-1].isspace() and not (n == end and not piece):
                found.append(piece)
            else:
                found[-1] = f"{before} {piece}"
        return found

    def align(self, units: list[str]) -> Aligned:
        """Token ids and byte ends of all units (or joined ones), laid end to end."""
        spaced = [f" {u}" for u in units]
        whole = "".join(spaced)
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], np.cumsum(1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000))])
        first = np.concatenate([[0], np.cumsum([len(s) for s in spaced])]).astype(np.int64)
        in_a = self.a.encode_batch(spaced, add_special_tokens=False)
        ids_a, spans_a = [e.ids for e in in_a], [e.offsets for e in in_a]
        in_b = self.b.encode(units, return_type="offset_mapping", num_threads=1)
        ids_b, spans_b = [e["ids"] for e in in_b], [e["offsets"] for e in in_b]
        sides = []
        for ids, spans, names, lengths, shift in ((ids_a, spans_a, self.bytes_a, self.length_a, 0), (ids_b, spans_b, self.bytes_b, self.length_b, 1)):
            counts = np.array([len(i) for i in ids], np.int64)
            flat = np.fromiter(chain.from_iterable(ids), np.int64, counts.sum())
            bounds = np.fromiter(chain.from_iterable(chain.from_iterable(spans)), np.int64, 2 * counts.sum()).reshape(-1, 2) + shift
            starts = np.concatenate([[0], np.cumsum(counts)])
            if shift and len(flat):
                bounds[starts[:-1][counts > 0], 0] = 0  # B's own blank belongs to its first piece
            bounds += np.repeat(first[:-1], counts)[:, None]
            coarse_from, coarse_to = at[np.clip(bounds, 0, len(at) - 1)].T
            width = lengths[flat]
            spelled = np.cumsum(width)
            before = np.concatenate([[0], spelled])[starts[:-1]]
            refined = spelled - np.repeat(before - at[first[:-1]], counts)
            ends = np.where(coarse_to - coarse_from == width, coarse_to, refined)
            sides.append((flat, ends, counts, self._spelled(flat, counts, width, names, whole.encode(), at[first])))
        (a, ends_a, n_a, good_a), (b, ends_b, n_b, good_b) = sides
        return Aligned(a, ends_a, n_a, b, ends_b, n_b, good_a & good_b)

    @staticmethod
    def _spelled(flat: np.ndarray, counts: np.ndarray, width: np.ndarray, names: list[bytes], text: bytes, bounds: np.ndarray) -> np.ndarray:
        """Of each unit, whether its tokens' bytes are those of the text between its bounds."""
        sizes = np.bincount(np.repeat(np.arange(len(counts)), counts), width, len(counts)).astype(np.int64)
        long_enough = sizes == np.diff(bounds)
        own = np.repeat(long_enough, counts)
        joined = np.frombuffer(b"".join(map(names.__getitem__, flat[own].tolist())), np.uint8)
        asked = np.frombuffer(text, np.uint8)[np.repeat(long_enough, np.diff(bounds))]
        unit = np.repeat(np.flatnonzero(long_enough), sizes[long_enough])
        long_enough[unit[joined != asked]] = False
        return long_enough

    def unit_rows(self, units: list[str]) -> list[Unit]:
        """What documents are put together from. Units are joined for the tokenizers, as no token reaches from one to the next."""
        joined = self._joined(units)
        aligned = self.align([" ".join(units[low:high]) for low, high in joined])
        rows: list[Unit] = [LOSSY] * len(units)
        good, alone = [], []
        for (low, high), lossless in zip(joined, aligned.lossless.tolist(), strict=True):
            if lossless:
                good.extend(range(low, high))
            elif high - low > 1:
                alone.extend(range(low, high))
        for place, row in zip(good, self._rows_of(aligned, units, np.array(good, np.int64)), strict=True):
            rows[place] = row
        if alone:  # one of them is not spelled exactly
            for place in alone:
                rows[place] = self.unit_rows([units[place]])[0]
        return rows

    def _joined(self, units: list[str]) -> list[tuple[int, int]]:
        """Bounds of parts to be joined; units that end in white space could be merged with a blank behind them."""
        bounds, low = [], 0
        for place, unit in enumerate(units):
            if not self.cut or unit[-1:].isspace() or not unit or place - low + 1 == JOINED_UNITS:
                if place > low and (not self.cut or unit[-1:].isspace() or not unit):
                    bounds.append((low, place))
                    low = place
                bounds.append((low, place + 1))
                low = place + 1
        return bounds + ([(low, len(units))] if low < len(units) else [])

    def _rows_of(self, aligned: Aligned, all_units: list[str], good: np.ndarray) -> list[Unit]:
        """Rows of the units whose places are given; tokens fall to units by their ends."""
        a, ends_a, b, ends_b = aligned.lossless_tokens()
        bounds = np.cumsum([len(u.encode()) + 1 for u in all_units])[good]
        units = len(good)
        ends = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        pairs = a[at_a] * self.size_b + b[at_b]
        closing = np.isin(ends_a, ends_b), np.isin(ends_b, ends_a)
        unit_a, unit_b = np.searchsorted(bounds, ends_a), np.searchsorted(bounds, ends_b)
        counts_a, counts_b = np.bincount(unit_a, minlength=units), np.bincount(unit_b, minlength=units)
        unit_of_end = unit_a[at_a]
        n_links, n_groups = np.bincount(unit_of_end, minlength=units), np.bincount(unit_a[closing[0]], minlength=units)
        # Ids as digits with a mark behind each: ',' within a group, '|' between the sides, ';' after a group.
        width = len(str(max(len(self.bytes_a), self.size_b)))
        cells_a = digits(a, np.where(closing[0], ord("|"), ord(",")), width)
        cells_b = digits(b, np.where(closing[1], ord(";"), ord(",")), width)
        group_a = np.cumsum(closing[0]) - closing[0]
        group_b = np.cumsum(closing[1]) - closing[1]
        order = np.lexsort((np.concatenate([np.zeros(len(a)), np.ones(len(b))]), np.concatenate([group_a, group_b])))
        cells = np.concatenate([cells_a, cells_b])[order]
        of_unit = np.concatenate([unit_a, unit_b])[order]
        shown = cells != 0
        text = cells[shown].tobytes()
        cut = np.concatenate([[0], np.cumsum(np.bincount(of_unit, shown.sum(1), units).astype(np.int64))]).tolist()
        links = np.concatenate([[0], np.cumsum(n_links * self.kind.itemsize)]).tolist()
        packed_pairs = pairs.astype(self.kind).tobytes()
        columns = (x.tolist() for x in (counts_a, counts_b, n_groups))
        return [
            (True, x, y, g, text[cut[k] : cut[k + 1] - 1], packed_pairs[links[k] : links[k + 1]])
            for k, (x, y, g) in enumerate(zip(*columns, strict=True))
        ]


class Aligned(NamedTuple):
    """Ids, byte ends and counts per unit of both sides, and which units both spell exactly."""

    a: np.ndarray
    ends_a: np.ndarray
    n_a: np.ndarray
    b: np.ndarray
    ends_b: np.ndarray
    n_b: np.ndarray
    lossless: np.ndarray

    def lossless_tokens(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        in_a, in_b = np.repeat(self.lossless, self.n_a), np.repeat(self.lossless, self.n_b)
        return self.a[in_a], self.ends_a[in_a], self.b[in_b], self.ends_b[in_b]


def digits(ids: np.ndarray, mark: np.ndarray, width: int) -> np.ndarray:
    """Decimal digits of each id, then its mark, in rows of bytes; zero bytes stand for nothing."""
    powers = 10 ** np.arange(width - 1, -1, -1)
    figures = ids[:, None] // powers
    shown = (figures > 0) | (powers == 1)
    return np.column_stack([np.where(shown, figures % 10 + ord("0"), 0), mark]).astype(np.uint8)


@cache
def _tokenizers(path_a: str, path_b: str) -> tuple[Tokenizers, list[dict[str, Unit]]]:
    return Tokenizers(path_a, path_b), [{}, {}]


def _known(tokenizers: Tokenizers, generations: list[dict[str, Unit]], units: set[str]) -> dict[str, Unit]:
    """The aligned units, from the newer table, the older one, or the tokenizers."""
    newer, older = generations
    found = {}
    missing = []
    for unit in units:
        row = newer.get(unit) or older.get(unit)
        if row is None:
            missing.append(unit)
        else:
            found[unit] = row
    start = 0
    while start < len(missing):
        stop, characters = start, 0
        while stop < len(missing) and stop - start < UNITS_AT_ONCE and characters < CHARACTERS_AT_ONCE:
            characters += len(missing[stop])
            stop += 1
        found.update(zip(missing[start:stop], tokenizers.unit_rows(missing[start:stop]), strict=True))
        start = stop
    newer.update((u, r) for u, r in found.items() if len(u) <= REMEMBERED_LENGTH)
    if len(newer) > REMEMBERED_UNITS:
        generations[:] = [{}, newer]
    return found


def default_paths() -> tuple[str, str]:
    from public_tokenizers import path

    return path("byte_bpe_50k.json"), path("piece_bpe_32k.model")


def _batches(texts: pd.Series) -> Iterator[tuple[int, list[str]]]:
    """Texts in parts of bounded length, with the place of the first."""
    start, part, characters = 0, [], 0
    for place, text in enumerate(texts):
        part.append(text)
        characters += len(text)
        if characters >= CHARACTERS_AT_ONCE:
            yield start, part
            start, part, characters = place + 1, [], 0
    if part:
        yield start, part


def aligned_documents(documents: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and the distinct linked pairs with their numbers.

    A pair's key is A's id times the size of B's vocabulary plus B's id; keys and times are packed, as they are many.
    """
    path_a, path_b = (given or default for given, default in zip((path_a, path_b), default_paths(), strict=True))

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizers, generations = _tokenizers(path_a, path_b)
        for batch in batches:
            for start, texts in _batches(batch["text"]):
                cut = [tokenizers.units(t) if t else [] for t in texts]
                known = _known(tokenizers, generations, {u for units in cut for u in units})
                rows = [document_row([known[u] for u in units], tokenizers.kind) for units in cut]
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[start : start + len(texts)].array} | dict(zip(COLUMNS, zip(*rows, strict=True), strict=True)))

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInPandas(align, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys binary, times binary")


NO_TOKENS = (0, 0, 0, 0, "", b"", b"")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "keys", "times")


def document_row(units: list[Unit], kind: np.dtype) -> tuple:
    if not units:
        return NO_TOKENS
    lossless, n_a, n_b, n_groups, groups, pairs = zip(*units, strict=True)
    if not all(lossless):
        return NO_TOKENS
    links = np.frombuffer(b"".join(pairs), kind)
    keys, times = np.unique(links, return_counts=True)
    return sum(n_a), sum(n_b), sum(n_groups), len(links), sha256(b";".join(groups)).hexdigest(), packed(keys), packed(times)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in the fewest of 1, 2, 4 or 8 bytes each, which is stated first."""
    if not len(values):
        return b""
    kind = np.min_scalar_type(int(values.max()))
    return bytes([kind.itemsize]) + values.astype(kind).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64) if data else np.zeros(0, np.int64)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """key and docs: how many documents hold the pair linked."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def counted() -> pd.DataFrame:
            keys, docs = np.unique(np.concatenate(held), return_counts=True)
            return pd.DataFrame({"key": keys, "docs": docs})

        for batch in batches:
            for data in batch["keys"]:
                held.append(unpacked(data))
                size += len(held[-1])
                if size >= PAIRS_AT_ONCE:
                    yield counted()
                    held, size = [], 0
        if size:
            yield counted()

    return aligned.select("keys").mapInPandas(count, "key long, docs long").groupBy("key").agg(F.sum("docs").alias("docs"))


def alignment_digest(documents: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per document: counts, links with their A id's best count, the sum of counts, and a digest of the groups."""
    path_a, path_b = (given or default for given, default in zip((path_a, path_b), default_paths(), strict=True))
    size_b = Tokenizers(path_a, path_b).size_b
    aligned = written(aligned_documents(documents, path_a, path_b).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = written(pair_counts(aligned), "pairs")
    # One row per id of A's vocabulary: a broadcast of that size, whatever the corpus.
    highest = counts.groupBy(F.floor(F.col("key") / size_b).alias("a")).agg(F.max("docs").alias("highest"))
    judged = counts.withColumn("a", F.floor(F.col("key") / size_b)).join(F.broadcast(highest), "a").select(
        "key", "docs", (F.col("docs") == F.col("highest")).alias("best")
    )
    judged = written(judged, "judged-pairs")
    least = _least_common(judged)
    common = judged.where(F.col("docs") >= least).orderBy("key").toPandas()
    held = documents.sparkSession.sparkContext.broadcast(tuple(common[c].to_numpy() for c in ("key", "docs", "best")))

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, docs, best = held.value
        for batch in batches:
            rows = []
            for packed_keys, packed_times in zip(batch.pop("keys"), batch.pop("times"), strict=True):
                own, times = unpacked(packed_keys), unpacked(packed_times)
                place = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
                there = keys[place] == own if len(keys) else np.zeros(len(own), bool)
                at, n = place[there], times[there]
                rows.append((int(n[best[at]].sum()), int((docs[at] * n).sum()), own[~there], times[~there]))
            yield batch.assign(**dict(zip(("n_best", "count_sum", "rare", "rare_times"), zip(*rows, strict=True), strict=True)))

    kinds = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, row long"
    looked = written(aligned.mapInPandas(look_up, f"{kinds}, n_best long, count_sum long, rare array<long>, rare_times array<long>"), "looked-up")
    rare = looked.select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("p")).select("row", F.col("p.rare").alias("key"), F.col("p.rare_times").alias("times"))
    others = rare.join(judged.where(F.col("docs") < least), "key").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("docs") * F.col("times")).alias("more_sum")
    )
    rows = looked.drop("rare", "rare_times").join(others, "row", "left")
    return rows.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256",
    )


def _least_common(judged: DataFrame) -> int:
    """The least power of two so that at most ``COMMON_PAIRS`` pairs have a count of that or more; one row per power comes back."""
    sizes = judged.groupBy((F.length(F.bin("docs")) - 1).alias("power")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("power")).collect()
    least, total = 2 ** ((sizes[0]["power"] + 1) if sizes else 0), 0
    for power, n in sizes:
        total += n
        if total > COMMON_PAIRS:
            break
        least = 2**power
    return least

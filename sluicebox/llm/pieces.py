"""SentencePiece encoding with seeded merge dropout, and lossless decoding.

A text is cut where no piece of the vocabulary can reach across: before blanks that follow another character, and around
line breaks. Each unit is segmented by the agenda of a merge-type model: the best scored pair of neighbours, leftmost
first, is merged until none is left. A popped merge is skipped with the dropout rate, by draws from a keyed hash of seed,
document and place of the unit in its text, so every occurrence of a unit, whatever its length, draws for itself, and a
seed always gives the same segmentation. The draws are the numbers of pops between two skips, which is the same as one
draw per pop. What an occurrence gets depends only on the pops it skips; tasks remember segmentations by unit and
skipped pops, so most occurrences cost a look-up. With rate 0 the pieces are those of the model itself.

Decoding is exact for every text: characters without a piece, line breaks and a literal block mark (U+2581, which the
model would read as a blank) are spelled in byte pieces.

Defined results: null and empty texts have no pieces and decode to the empty text; equal texts of one doc_id are equal in
result; unpaired surrogates can't occur in Spark strings. Texts are read whole. Tasks keep a bounded table of segmented
units. Other columns are ignored by ``encode_documents``.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b, sha256
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.llm.common import whole_text

RATE, SEED = 0.1, 17
REMEMBERED_UNITS = 300_000  # of each of two generations in a task process
MARK = "▁"
UNIT = re.compile(r" *[^ \n]+| +|\n")
NEVER, SHORT = float("inf"), 48
ROWS_AT_ONCE = 500
MOST_CHARS = 64  # of a unit whose skipped segmentations are remembered
ALWAYS = 1 << 62  # a pop that no unit reaches
STEP, FOLD, WORD = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, (1 << 64) - 1


@dataclass
class Vocabulary:
    """Pieces by number; of those that merges may make, numbers, costs and neighbouring characters; the first byte piece."""

    pieces: list[str]
    numbers: dict[str, int]
    costs: dict[str, float]
    pairs: frozenset[str]
    first_byte: int

    @staticmethod
    def load(path: str) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        numbers = {p: i for i, p in enumerate(pieces) if not special[i]}
        if any(MARK in p.lstrip(MARK) or (p.startswith(MARK * 2) and p.strip(MARK)) or "\n" in p for p in numbers):
            raise ValueError("a piece reaches across blanks or lines; units would not be independent")
        costs = {p: -model.get_score(i) for p, i in numbers.items()}
        pairs = frozenset(p[i : i + 2] for p in numbers for i in range(len(p) - 1))
        return Vocabulary(pieces, numbers, costs, pairs, model.piece_to_id("<0x00>"))


class Draws:
    """The pops that one occurrence skips, counted over its unit: gaps between them follow from a keyed hash."""

    def __init__(self, limits: list[int], seed: int) -> None:
        self.limits, self.seed = limits, seed
        self.next = -1
        self.skipped: list[int] = []
        self.advance()

    def advance(self) -> None:
        """On to the next skipped pop."""
        if not self.limits:
            self.next = ALWAYS
            return
        drawn = self.seed = (self.seed + STEP) & WORD
        drawn = (drawn ^ drawn >> 30) * FOLD & WORD
        self.next += 1 + len(self.limits) - bisect_right(self.limits, (drawn ^ drawn >> 31) >> 33)

    def skip(self) -> None:
        self.skipped.append(self.next)
        self.advance()


def gap_limits(rate: float) -> list[int]:
    """Of 31 bits: below the k-th largest limit, at least k pops lie before a skip. Whole numbers, equal on every machine."""
    share = (1 << 31) - int(rate * (1 << 31))
    limits = []
    left = share if share < 1 << 31 else 0
    while left:
        limits.append(left)
        left = left * share >> 31
    return limits[::-1] or ([0] if share < 1 << 31 else [])


def _merge_short(symbols: list[str], costs: dict[str, float], draws: Draws, pops: int = 0) -> tuple[list[int], list[str], int]:
    """The agenda as a list that is searched: quickest for a few symbols. Pops are counted on from ``pops``."""
    places = list(range(len(symbols)))
    cost = [costs.get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]  # noqa: B905
    while cost:
        least = min(cost)
        if least == NEVER:
            break
        i = cost.index(least)
        pops += 1
        if pops > draws.next:
            draws.skip()
            cost[i] = NEVER
            continue
        symbols[i] += symbols[i + 1]
        del symbols[i + 1], places[i + 1], cost[i]
        if i < len(cost):
            cost[i] = costs.get(symbols[i] + symbols[i + 1], NEVER)
        if i:
            cost[i - 1] = costs.get(symbols[i - 1] + symbols[i], NEVER)
    return places, symbols, pops


def _merge_long(start: list[str], costs: dict[str, float], draws: Draws, pops: int = 0) -> tuple[list[int], list[str], int]:
    """The same merges with the agenda as a heap."""
    symbols: list[str | None] = list(start)
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[float, int, int, str]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < n:
            merged = symbols[left] + symbols[right]
            if (cost := costs.get(merged)) is not None:
                heapq.heappush(agenda, (cost, left, right, merged))

    for i in range(n - 1):
        offer(i)
    while agenda:
        _, left, right, merged = heapq.heappop(agenda)
        if symbols[left] is None or after[left] != right or symbols[left] + symbols[right] != merged:
            continue
        pops += 1
        if pops > draws.next:
            draws.skip()
            continue
        symbols[left], symbols[right] = merged, None
        follow = after[left] = after[right]
        if follow < n:
            before[follow] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    places = [i for i, s in enumerate(symbols) if s is not None]
    return places, [symbols[i] for i in places], pops


@dataclass
class Encoder:
    """Segments units for one seed and rate; one per task process."""

    vocabulary: Vocabulary
    rate: float = RATE
    seed: int = SEED
    known: dict[str, tuple[int, tuple[int, ...]]] = field(default_factory=dict)
    older: dict[str, tuple[int, tuple[int, ...]]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.limits = gap_limits(self.rate)
        self.bounds = np.array(self.limits, np.uint64)

    def remembered(self, key: str) -> tuple[int, tuple[int, ...]] | None:
        """Pops and piece numbers that are known. What is still in use moves to the newer of two generations."""
        found = self.known.get(key)
        if found is None and (found := self.older.get(key)):
            self.keep(key, found)
        return found

    def keep(self, key: str, found: tuple[int, tuple[int, ...]]) -> None:
        if len(self.known) >= REMEMBERED_UNITS:
            self.older, self.known = self.known, {}
        self.known[key] = found

    def plain(self, text: str) -> tuple[int, tuple[int, ...]]:
        """Pops and piece numbers of a unit of which nothing is skipped."""
        found = self.remembered(text)
        if found is None:
            found = self.unit(text, Draws([], 0))
            self.keep(text, found)
        return found

    def occurrence(self, text: str, seed: int, skip: int) -> tuple[int, ...]:
        """Piece numbers of an occurrence; ``seed`` is its own, ``skip`` the first pop it skips. A unit that is new is run
        once, as this occurrence has it. No unit that skips holds a line break."""
        plain = self.remembered(text)
        if plain is not None and skip >= plain[0]:
            return plain[1]
        repeated = plain is not None and len(text) <= MOST_CHARS
        if repeated:
            draws, name = Draws(self.limits, seed), text + "\n"
            while True:
                name += chr(draws.next)
                draws.skip()
                found = self.remembered(name)
                if found is None:
                    break
                if draws.next >= found[0]:
                    return found[1]
        draws = Draws(self.limits, seed)
        found = self.unit(text, draws)
        if not draws.skipped:
            self.keep(text, found)
        elif repeated:
            self.keep(text + "\n" + "".join(map(chr, draws.skipped)), found)
        return found[1]

    def unit(self, text: str, draws: Draws) -> tuple[int, tuple[int, ...]]:
        """Pops and piece numbers of one unit. It is cut first between characters that stand side by side in no piece."""
        pairs = self.vocabulary.pairs
        shown = text.replace(" ", MARK)
        cuts = [i for i, pair in enumerate(map(str.__add__, shown, shown[1:]), 1) if pair not in pairs]
        if not cuts:
            return self.atom(text, draws, 0)
        out: list[int] = []
        pops = 0
        for i, j in zip([0, *cuts], [*cuts, len(text)], strict=True):
            part, before, skips = text[i:j], pops, len(draws.skipped)
            known = self.remembered(part)
            if known is not None and draws.next >= pops + known[0]:
                pops, numbers = pops + known[0], known[1]
            else:
                pops, numbers = self.atom(part, draws, pops)
                if len(draws.skipped) == skips:
                    self.keep(part, (pops - before, numbers))
            out.extend(numbers)
        return pops, tuple(out)

    def atom(self, text: str, draws: Draws, pops: int) -> tuple[int, tuple[int, ...]]:
        """Pops, counted on, and piece numbers of characters that may all merge."""
        literal = MARK in text
        symbols = list((text.replace(MARK, "\n") if literal else text).replace(" ", MARK))
        places, merged, pops = (_merge_short if len(symbols) <= SHORT else _merge_long)(symbols, self.vocabulary.costs, draws, pops)
        out = list(map(self.vocabulary.numbers.get, merged))
        if None not in out:
            return pops, tuple(out)
        spelled: list[int] = []
        for i, number in zip(places, out, strict=True):
            if number is not None:
                spelled.append(number)
            else:
                spelled.extend(self.vocabulary.first_byte + b for b in text[i].encode("utf-8", "surrogatepass"))
        return pops, tuple(spelled)

    def seeds(self, key: str, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each place of a document: the seed of its draws, and the first pop it skips, both from a keyed hash."""
        own = int.from_bytes(blake2b(key.encode("utf-8", "surrogatepass"), digest_size=8, key=b"%d" % self.seed).digest(), "little")
        seeds = (np.arange(1, count + 1, dtype=np.uint64) * np.uint64(FOLD)) ^ np.uint64(own)
        seeds = (seeds ^ seeds >> np.uint64(32)) * np.uint64(STEP)
        drawn = seeds + np.uint64(STEP)
        drawn = (drawn ^ drawn >> np.uint64(30)) * np.uint64(FOLD)
        return seeds, len(self.bounds) - np.searchsorted(self.bounds, (drawn ^ drawn >> np.uint64(31)) >> np.uint64(33), "right")

    def encode(self, text: str, key: str = "") -> list[int]:
        if not text:
            return []
        out: list[int] = []
        units = UNIT.findall(" " + text)
        if not self.limits:
            for unit in units:
                out.extend(self.plain(unit)[1])
            return out
        seeds, first = self.seeds(key, len(units))
        for place, (unit, skip) in enumerate(zip(units, first.tolist(), strict=True)):
            found = self.known.get(unit)
            out.extend(found[1] if found is not None and skip >= found[0] else self.occurrence(unit, int(seeds[place]), skip))
        return out


def decode(numbers: list[int], vocabulary: Vocabulary) -> str:
    """The text of piece numbers: blanks for marks, bytes joined, and the blank that encoding puts in front removed."""
    if not len(numbers):
        return ""
    first, pieces = vocabulary.first_byte, vocabulary.pieces
    if min(numbers) >= first + 256:
        return "".join(map(pieces.__getitem__, numbers)).replace(MARK, " ")[1:]
    parts: list[str] = []
    held = bytearray()
    for i in numbers:
        if first <= i < first + 256:
            held.append(i - first)
            continue
        if held:
            parts.append(held.decode("utf-8", "surrogatepass"))
            held.clear()
        parts.append(pieces[i].replace(MARK, " "))
    if held:
        parts.append(held.decode("utf-8", "surrogatepass"))
    return "".join(parts)[1:]


_encoders: dict[tuple[int, float, int], Encoder] = {}


def _encoder(vocabulary: Vocabulary, rate: float, seed: int) -> Encoder:
    """The process's encoder for these settings, so that later tasks find its units segmented."""
    key = (len(vocabulary.pieces), rate, seed)
    found = _encoders.get(key)
    if found is None or found.vocabulary.pieces != vocabulary.pieces:
        found = _encoders[key] = Encoder(vocabulary, rate, seed)
    return found


def default_model() -> str:
    from public_tokenizers import path

    return path("piece_bpe_32k.model")


def shared_vocabulary(spark: SparkSession, model: str | None = None):  # noqa: ANN201  a broadcast variable
    """The vocabulary, read on the driver from ``model`` and broadcast: its size is that of the model, not of the data."""
    return spark.sparkContext.broadcast(Vocabulary.load(model or default_model()))


def encode_documents(documents: DataFrame, model: str | None = None, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """doc_id, text and ``pieces`` (numbers) of each document."""
    shared = shared_vocabulary(documents.sparkSession, model)

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(shared.value, rate, seed)
        for batch in batches:
            for start in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.iloc[start : start + ROWS_AT_ONCE]
                pieces = [np.array(encoder.encode(t, k), np.int32) for k, t in zip(part["key"], part["text"], strict=True)]
                yield pd.DataFrame({"doc_id": part["doc_id"], "text": part["text"], "pieces": pieces})

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), whole_text().alias("text"))
    return rows.mapInPandas(compute, f"doc_id {kind}, text string, pieces array<int>")


def decode_pieces(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """The columns of ``encoded`` and ``decoded``, the text of its pieces."""
    shared = shared_vocabulary(encoded.sparkSession, model)

    def text_of(pieces: pd.Series) -> pd.Series:
        return pd.Series([decode(p.tolist(), shared.value) for p in pieces])

    return encoded.withColumn("decoded", F.pandas_udf(text_of, "string")("pieces"))


def piece_digest(documents: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, number and checksum of pieces, digest of the text decoded from them, and whether it equals the text.

    A task encodes and decodes text by text, so neither pieces nor decoded texts travel or gather.
    """
    shared = shared_vocabulary(documents.sparkSession, model)

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = shared.value
        encoder = _encoder(vocabulary, RATE, SEED)
        for batch in batches:
            rows = []
            for key, text in zip(batch["key"], batch["text"], strict=True):
                numbers = encoder.encode(text, key)
                back = decode(numbers, vocabulary)
                raw = back.encode("utf-8", "surrogatepass")
                rows.append((len(numbers), crc32(np.array(numbers, "<i4").tobytes()), sha256(raw).hexdigest(), back == text))
            found = pd.DataFrame(rows, columns=["n_pieces", "pieces_crc32", "decoded_sha256", "lossless"])
            yield found.assign(doc_id=batch["doc_id"].to_numpy())[["doc_id", *found.columns]]

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), whole_text().alias("text"))
    return rows.mapInPandas(compute, f"doc_id {kind}, n_pieces long, pieces_crc32 long, decoded_sha256 string, lossless boolean")

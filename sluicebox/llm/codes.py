"""Vector codes: each part of a vector as the number of its nearest codebook entry, learned over all vectors.

Components are whole numbers, floor(1024 * x), and a vector is cut into ``PARTS`` consecutive parts. Vectors are dealt in blocks of at
most ``BLOCK`` rows; each block holds one metric tree per part over its distinct part vectors. Trees follow the anchors
hierarchy, middle-out: about the square root of the points become anchors, each new one at the point that lies
farthest from its anchor, and takes the points that are nearer to it; anchors are then joined upwards, the tightest pair
first, and split downwards in the same way. Each ball caches count and sum of its points. In a round, a ball inherits
the list of entries that its parent left, and drops those that no point inside can be nearest to; once one is left, the
ball is owned by it, and its cached sum and count are added as a whole. Trees are built once and written; rounds
read them, and Spark adds the sums. What comes to the driver is the codebook alone.

Arithmetic is exact: whole numbers in doubles below 2 ** 53, Python's numbers for blocks or codebooks with larger ones; balls
drop an entry only by a margin far above rounding.

Defined results: vectors that are null, empty, or hold null or non-finite components are dropped, as are vectors of
another length than the first kept one (least vec_id, then least components). Components beyond 2 ** 62 in size
count as that. Where the length is no multiple of ``PARTS``, part i covers components i * n // PARTS up to (i + 1) * n // PARTS. Rows that
repeat a vec_id are vectors of their own; null ids come last. With fewer than ``ENTRIES`` vectors there are fewer entries; no vectors
give no rows. Errors beyond a long are null. Other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK, LEAF = 4096, 16
CLIP = 2.0**62
EXACT = 2.0**53
SALTS = 64
MOST_BROADCAST_LABELS = 100_000  # of some 40 bytes each; beyond it the same sums are joined by a salted shuffle
LONGEST = 2**63 - 1


class Tree(NamedTuple):
    """A metric tree over distinct part vectors: balls in rows, children behind their parents; ``order`` are rows of the block."""

    points: np.ndarray  # distinct part vectors, in the order of the leaves
    counts: np.ndarray  # how many rows each stands for
    place: np.ndarray  # of each row of the block, its point
    low: np.ndarray
    high: np.ndarray
    left: np.ndarray  # -1 for leaves
    right: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    total: np.ndarray  # sums of the rows below
    weight: np.ndarray

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, *self)
        return out.getvalue()

    @staticmethod
    def unpacked(data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as arrays:
            return Tree(*(arrays[f"arr_{i}"] for i in range(len(Tree._fields))))


def _length(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows * rows).sum(-1))


def anchors(points: np.ndarray) -> list[np.ndarray]:
    """The points dealt to about as many anchors as the square root of their number, by place."""
    pivots = points[:1]
    owner, distance = np.zeros(len(points), np.int64), _length(points - points[0])
    for new in range(1, int(np.ceil(np.sqrt(len(points))))):
        farthest = int(distance.argmax())
        if distance[farthest] == 0:
            break
        pivot = points[farthest]
        # A point nearer to its anchor than half the way to the new one stays there.
        near = np.flatnonzero(distance > _length(pivots - pivot)[owner] / 2)
        to_new = _length(points[near] - pivot)
        taken = to_new < distance[near]
        owner[near[taken]], distance[near[taken]] = new, to_new[taken]
        pivots = np.vstack([pivots, pivot])
    return [rows for rows in (np.flatnonzero(owner == k) for k in range(len(pivots))) if len(rows)]


def _joined(balls: list[tuple], centers: np.ndarray, radii: np.ndarray) -> tuple:
    """Nested pairs of the balls: again and again the two whose common ball is smallest."""
    nodes, weight = list(balls), np.ones(len(balls))
    alive = list(range(len(balls)))
    while len(alive) > 1:
        c, r = centers[alive], radii[alive]
        span = (_length(c[:, None] - c[None]) + r[:, None] + r[None]) / 2
        np.fill_diagonal(span, np.inf)
        i, j = divmod(int(span.argmin()), len(alive))
        i, j = min(i, j), max(i, j)
        a, b = alive[i], alive[j]
        whole = weight[a] + weight[b]
        centers[a] = (centers[a] * weight[a] + centers[b] * weight[b]) / whole
        radii[a], weight[a], nodes[a] = span[i, j], whole, (nodes[a], nodes[b])
        del alive[j]
    return nodes[alive[0]]


def _shape(points: np.ndarray, rows: np.ndarray) -> tuple | np.ndarray:
    """Nested pairs of row lists; a list is a leaf."""
    if len(rows) <= LEAF:
        return rows
    groups = anchors(points[rows])
    if len(groups) == 1:
        return rows
    centers = np.array([points[rows[g]].mean(0) for g in groups])
    radii = np.array([_length(points[rows[g]] - c).max() for g, c in zip(groups, centers, strict=True)])
    return _joined([_shape(points, rows[g]) for g in groups], centers, radii)


def grow(vectors: np.ndarray) -> Tree:
    """The tree of a block's part vectors."""
    points, place, counts = np.unique(vectors, axis=0, return_inverse=True, return_counts=True)
    place = place.ravel()
    order, balls = [], []  # balls: low, high, left, right
    filled = 0
    stack = [(_shape(points, np.arange(len(points))), -1, False)]
    while stack:
        shape, parent, second = stack.pop()
        number = len(balls)
        if parent >= 0:
            balls[parent][3 if second else 2] = number
        if isinstance(shape, tuple):
            balls.append([filled, -1, -1, -1])
            stack += [(shape[1], number, True), (shape[0], number, False)]
        else:
            balls.append([filled, filled + len(shape), -1, -1])
            order.append(shape)
            filled += len(shape)
    for ball in reversed(balls):  # children have higher numbers
        if ball[1] < 0:
            ball[1] = balls[ball[3]][1]
    order = np.concatenate(order)
    points, counts = points[order], counts[order]
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    low, high, left, right = np.array(balls, np.int64).T
    sums = np.concatenate([np.zeros((1, points.shape[1])), np.cumsum(points * counts[:, None], 0)])
    rows = np.concatenate([[0], np.cumsum(counts)])
    center = np.array([points[a:b].mean(0) for a, b in zip(low, high, strict=True)])
    radius = np.array([_length(points[a:b] - c).max() for a, b, c in zip(low, high, center, strict=True)])
    return Tree(points, counts, back[place], low, high, left, right, center, radius, sums[high] - sums[low], rows[high] - rows[low])


def exactly_in_doubles(*arrays: np.ndarray) -> bool:
    """Whether squared distances and sums over a block stay whole numbers below 2 ** 53."""
    most = max((float(np.abs(a).max()) for a in arrays if a.size), default=0.0)
    width = arrays[0].shape[-1]
    return 4 * most * most * width < EXACT and most * BLOCK < EXACT


def nearest_entries(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The entry of each point of the tree, and the balls that a single entry owns (by number)."""
    entry = np.zeros(len(tree.points), np.int64)
    owned = []
    distinct = np.sort(np.unique(book, axis=0, return_index=True)[1])  # of equal entries the first one wins every tie
    stack = [(0, distinct)]
    while stack:
        ball, entries = stack.pop()
        away = book[entries] - tree.center[ball]
        square = (away * away).sum(1)
        best = int(square.argmin())
        # For x in the ball: |x-c|^2 - |x-best|^2 >= |p-c|^2 - |p-best|^2 - 2 r |c-best|.
        reach = 2 * tree.radius[ball] * _length(away - away[best])
        margin = 1e-9 * (float(square.max()) + float(reach.max())) + 1e-6
        entries = entries[square - square[best] <= reach + margin]
        low, high = tree.low[ball], tree.high[ball]
        if len(entries) == 1:
            entry[low:high] = entries[0]
            owned.append(ball)
        elif tree.left[ball] < 0:
            to = tree.points[low:high, None] - book[entries][None]
            entry[low:high] = entries[(to * to).sum(2).argmin(1)]
        else:
            stack += [(tree.left[ball], entries), (tree.right[ball], entries)]
    return entry, owned


def _whole(values: np.ndarray) -> np.ndarray:
    """Python's whole numbers of an array of doubles without fractions."""
    return np.array([int(v) for v in values.ravel()], object).reshape(values.shape)


def sums_of(tree: Tree, book: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Of each entry that is used: the number of rows and the componentwise sums."""
    if not exactly_in_doubles(tree.points, book):
        entry, _ = plain_entries(tree.points, book)
        points = _whole(tree.points)
        return {
            int(e): (int(tree.counts[entry == e].sum()), [int(v) for v in (points[entry == e] * _whole(tree.counts[entry == e].astype(float))[:, None]).sum(0)])
            for e in np.unique(entry)
        }
    entry, owned = nearest_entries(tree, book)
    counts, sums = np.zeros(len(book), np.int64), np.zeros((len(book), tree.points.shape[1]))
    single = np.ones(len(entry), bool)
    for ball in owned:
        counts[entry[tree.low[ball]]] += tree.weight[ball]
        sums[entry[tree.low[ball]]] += tree.total[ball]
        single[tree.low[ball] : tree.high[ball]] = False
    np.add.at(counts, entry[single], tree.counts[single])
    np.add.at(sums, entry[single], tree.points[single] * tree.counts[single][:, None])
    return {int(e): (int(counts[e]), [int(v) for v in sums[e]]) for e in np.flatnonzero(counts)}


def plain_entries(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Entries and squared distances by Python's numbers, one point after the other."""
    whole, entries = _whole(points), _whole(book)
    entry, error = [], []
    for point in whole:
        square = ((entries - point) ** 2).sum(1)
        entry.append(min(range(len(square)), key=square.__getitem__))
        error.append(int(square[entry[-1]]))
    return np.array(entry, np.int64), error


def codes_of(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each row of the block."""
    if not exactly_in_doubles(tree.points, book):
        entry, error = plain_entries(tree.points, book)
        return entry[tree.place], np.array(error, object)[tree.place]
    entry, _ = nearest_entries(tree, book)
    away = tree.points - book[entry]
    return entry[tree.place], (away * away).sum(1).astype(np.int64)[tree.place]


def _bounds(length: int) -> list[tuple[int, int]]:
    return [(i * length // PARTS, (i + 1) * length // PARTS) for i in range(PARTS)]


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label, and components as whole numbers in doubles."""
    good = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    whole = F.transform("embedding", lambda x: F.greatest(F.least(x.cast("double") * SCALE, F.lit(CLIP)), F.lit(-CLIP)))
    rows = vectors.where(good & (F.size("embedding") > 0))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("x"))


def blocks_of(kept: DataFrame, length: int) -> DataFrame:
    """Blocks of vectors with the packed tree of each part."""
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), BLOCK):
                part = batch.iloc[start : start + BLOCK]
                matrix = np.floor(np.stack(part["x"].to_list()))
                trees = [grow(matrix[:, a:b]).packed() if b > a else b"" for a, b in _bounds(length)]
                ids, labels = part["vec_id"], part["label"]
                yield pd.DataFrame({
                    "ids": [ids.fillna(0).astype(np.int64).to_numpy()], "no_id": [ids.isna().to_numpy()],
                    "labels": [labels.fillna(0).astype(np.int64).to_numpy()], "no_label": [labels.isna().to_numpy()], "trees": [trees],
                })

    rows = kept.where(F.size("x") == length)
    return rows.mapInPandas(build, "ids array<long>, no_id array<boolean>, labels array<long>, no_label array<boolean>, trees array<binary>")


def first_codebooks(kept: DataFrame) -> list[np.ndarray]:
    """The parts of the first ``ENTRIES`` vectors by vec_id: that many rows come to the driver."""
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "x").limit(1).collect()
    if not first:
        return []
    length = len(first[0]["x"])
    rows = kept.where(F.size("x") == length).orderBy(F.asc_nulls_last("vec_id"), "x").limit(ENTRIES).collect()
    matrix = np.floor(np.array([r["x"] for r in rows]))
    return [matrix[:, a:b] for a, b in _bounds(length)]


def next_codebooks(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: every entry becomes the floored mean of its parts; unused entries stay."""
    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[int, int], tuple[int, list[int]]] = {}
        for batch in batches:
            for trees in batch["trees"]:
                for part, (packed, book) in enumerate(zip(trees, books, strict=True)):
                    for entry, (n, sums) in (sums_of(Tree.unpacked(packed), book) if packed else {}).items():
                        m, before = total.get((part, entry), (0, [0] * len(sums)))
                        total[part, entry] = m + n, [x + y for x, y in zip(before, sums, strict=True)]
        rows = [(part, entry, n, [str(s) for s in sums]) for (part, entry), (n, sums) in total.items()]
        yield pd.DataFrame(rows, columns=["part", "entry", "n", "sums"])

    sums = blocks.select("trees").mapInPandas(add_up, "part int, entry int, n long, sums array<string>")
    added = sums.select("part", "entry", "n", F.posexplode("sums").alias("at", "s")).groupBy("part", "entry", "at").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    )
    books = [b.copy() for b in books]
    for part, entry, at, n, s in added.collect():  # at most as many rows as the codebooks have components
        books[part][entry, at] = float(int(s) // n)
    return books


def books_digest(books: list[np.ndarray]) -> str:
    return sha256(",".join(str(int(v)) for b in books for v in b.ravel()).encode()).hexdigest()


def compress(vectors: DataFrame) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, entries (one number per part) and error of every kept vector, and the codebooks."""
    kept = written(kept_vectors(vectors), "vectors")
    books = first_codebooks(kept)
    blocks = written(blocks_of(kept, sum(b.shape[1] for b in books)), "trees")
    for _ in range(ROUNDS if books else 0):
        books = next_codebooks(blocks, books)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in batch.itertuples(index=False):
                found = [codes_of(Tree.unpacked(p), book) if p else (np.zeros(len(block.ids), np.int64),) * 2 for p, book in zip(block.trees, books, strict=True)]
                error = sum(e.astype(object) for _, e in found)
                yield pd.DataFrame({
                    "vec_id": pd.array(block.ids, "Int64").copy(), "label": pd.array(block.labels, "Int64").copy(),
                    "entries": list(np.column_stack([c for c, _ in found])),
                    "error": pd.array([int(e) if e <= LONGEST else pd.NA for e in error], "Int64"),
                }).assign(
                    vec_id=lambda f, gone=block.no_id: f["vec_id"].mask(np.asarray(gone, bool)), label=lambda f, gone=block.no_label: f["label"].mask(np.asarray(gone, bool))
                )

    return blocks.mapInPandas(assign, "vec_id long, label long, entries array<int>, error long"), books


def vector_codes(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every kept vector."""
    coded, books = compress(vectors)
    coded = written(coded, "codes")
    digits = F.array_join(F.transform("entries", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("whole"), F.count_if(F.col("error").isNull()).alias("unknown"))
    fits = (F.col("unknown") == 0) & (F.col("whole") <= F.lit(LONGEST))
    totals = written(sums.select("label", F.when(fits, F.col("whole").cast("long")).alias("label_error")), "label-errors")
    same = F.col("c.label").eqNullSafe(F.col("t.label"))
    if totals.count() <= MOST_BROADCAST_LABELS:
        joined = coded.alias("c").join(F.broadcast(totals.alias("t")), same, "left")
    else:  # a label may hold a third of all rows
        salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "entries"), F.lit(SALTS)))
        spread = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
        joined = salted.alias("c").join(spread.alias("t"), same & (F.col("c.salt") == F.col("t.salt")), "left")
    return joined.select("c.vec_id", digits.alias("code"), "c.error", "t.label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))

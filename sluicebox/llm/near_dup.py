"""Near duplicates by ProbMinHash: weighted five-word shingles, banding, exact verification, classes.

Each distinct shingle of a text, weighted by its count, is a Poisson process; its arrivals fall on ``REGISTERS`` registers,
each of which keeps the earliest one. An element stops as soon as its next arrival is later than every register. Two texts
agree on a register with their probability Jaccard similarity. Bands of three registers give buckets; members of a bucket
are verified by the exact probability Jaccard similarity of their shingle counts.

No bucket is expanded into all pairs. Members are compared with a leader first; links make classes; then other leaders are
tried where a bucket still holds several classes. What is left is settled exactly: members outside a bucket's largest class
are compared with every member of another class for which a link is possible by what each shares with the bucket's leader.
So copies of one text, however many, cost one comparison each.

Defined results: texts are lower-cased and split at white space; a text of one to four words is one shingle; equal
texts are one class. Null and empty texts and texts of white space have no shingle; each stays a class of its own, named by
its doc_id. Rows with equal doc_id are in one class. A row without doc_id takes the class of an equal text that has one, else
null. Other columns are ignored by ``near_duplicates`` and kept by ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicebox.llm.common import whole_text, written

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 16, 3
REGISTERS = BANDS * ROWS
CHUNK_BYTES = 1_000_000
LACKING = 2**32  # beyond the hashes of elements
MOST_BROADCAST_ROWS = 1_000_000  # of eight bytes each; beyond it the same join shuffles

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", BASE), ("down", BASE_INVERSE)):
                factors = np.full(n, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))
        return self.up, self.down


def shingles(texts: list[str], powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of each distinct shingle, ordered by text and hash."""
    joined = [" ".join(t.lower().split()).encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n".join(joined) + b"\n", np.uint8)
    up, down = powers.upto(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    gaps = np.flatnonzero((raw == 32) | (raw == 10))  # the end of each word
    starts, ends = np.concatenate([[0], gaps[:-1] + 1]), gaps
    last = np.flatnonzero(raw[gaps] == 10)  # the last word of each text
    first = np.concatenate([[0], last[:-1] + 1])
    words = last - first + 1
    words[np.array([not j for j in joined], bool)] = 0
    per = np.where(words >= WORDS, words - WORDS + 1, np.minimum(words, 1))
    text = np.repeat(np.arange(len(texts)), per)
    place = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per) + first[text]
    end = ends[np.minimum(place + WORDS - 1, last[text])]
    begin = starts[place]
    hashed = mix((sums[end] - sums[begin]) * down[begin])
    order = np.lexsort((hashed, text))
    text, hashed = text[order], hashed[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashed[1:] != hashed[:-1])
    at = np.flatnonzero(new)
    return text[at], hashed[at], np.diff(np.append(at, len(text)))


def registers_of(text: np.ndarray, hashed: np.ndarray, count: np.ndarray, texts: int) -> np.ndarray:
    """ProbMinHash signatures, one row of register values per text; texts without shingles keep zeros."""
    earliest = np.full(texts * REGISTERS, np.inf)
    values = np.zeros(texts * REGISTERS, np.uint64)
    time, rate, arrival = np.zeros(len(text)), count.astype(float), 0
    while len(text):
        arrival += 1
        drawn = mix(hashed + np.uint64(arrival * int(BASE) % (1 << 64)))
        time = time - np.log(((drawn >> np.uint64(11)).astype(float) + 0.5) / 2.0**53) / rate
        slot = text * REGISTERS + (mix(drawn) % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(earliest, slot, time)
        won = time == earliest[slot]
        values[slot[won]] = hashed[won]
        latest = earliest.reshape(texts, REGISTERS).max(1)
        live = time < latest[text]
        text, hashed, time, rate = text[live], hashed[live], time[live], rate[live]
    return values.reshape(texts, REGISTERS)


def _chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_BYTES:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, texts[start:]


def sketches(documents: DataFrame) -> DataFrame:
    """doc_id, text_key and bands (empty without shingles)."""
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = Powers()
        for batch in batches:
            for start, texts in _chunks(batch["text"].tolist()):
                part = batch.iloc[start : start + len(texts)]
                text, hashed, count = shingles(texts, powers)
                some = np.bincount(text, minlength=len(texts)) > 0
                values = registers_of(text, hashed, count, len(texts))
                keys = np.zeros((len(texts), BANDS), np.uint64)
                for b in range(BANDS):
                    key = np.full(len(texts), b, np.uint64)
                    for r in range(ROWS):
                        key = mix(key * BASE + values[:, b * ROWS + r])
                    keys[:, b] = key
                yield pd.DataFrame({
                    "doc_id": part["doc_id"], "text_key": part["text_key"],
                    "bands": [k.view(np.int64) if s else np.zeros(0, np.int64) for k, s in zip(keys, some, strict=True)],
                })

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    keyed = rows.withColumn("text_key", F.unhex(F.md5(F.col("text").cast("binary"))))
    return keyed.mapInPandas(compute, "doc_id long, text_key binary, bands array<long>")


def shingle_sets(documents: DataFrame) -> DataFrame:
    """node, hashes (32 bits, ascending) and counts (no bytes where all are one)."""
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = Powers()
        for batch in batches:
            for start, texts in _chunks(batch["text"].tolist()):
                text, hashed, count = shingles(texts, powers)
                cut = np.searchsorted(text, np.arange(len(texts) + 1))
                small, count = (hashed >> np.uint64(32)).astype(np.uint32), count.astype(np.uint32)
                parts = [(small[a:b], count[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pd.DataFrame({
                    "node": batch["node"].iloc[start : start + len(texts)],
                    "hashes": [h.tobytes() for h, _ in parts],
                    "counts": [c.tobytes() if (c > 1).any() else b"" for _, c in parts],
                })

    return documents.mapInPandas(compute, "node long, hashes binary, counts binary")


def probability_jaccard(a: tuple[bytes, bytes], b: tuple[bytes, bytes]) -> float:
    """The exact probability Jaccard similarity of two weighted sets, given as ``shingle_sets`` stores them."""
    ha, hb = np.frombuffer(a[0], np.uint32), np.frombuffer(b[0], np.uint32)
    if not len(ha) or not len(hb):
        return 0.0
    at = np.searchsorted(hb, ha)
    both = hb[np.minimum(at, len(hb) - 1)] == ha
    shared = int(both.sum())
    if not a[1] and not b[1]:
        return shared / (len(ha) + len(hb) - shared)
    wa = np.frombuffer(a[1], np.uint32).astype(float) if a[1] else np.ones(len(ha))
    wb = np.frombuffer(b[1], np.uint32).astype(float) if b[1] else np.ones(len(hb))
    x = wa[both]
    y = wb[at[both]]
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    order = np.argsort(x / y)
    x, y = x[order], y[order]
    from_x = np.cumsum(x[::-1])[::-1] + only_a  # elements with a ratio at least as large count by a's weight
    upto_y = np.concatenate([[0.0], np.cumsum(y)[:-1]]) + only_b
    return float((1 / (from_x / x + upto_y / y)).sum())


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b with a similarity of ``SIMILARITY`` or more."""
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = [
                probability_jaccard((ha, ca), (hb, cb)) >= SIMILARITY
                for ha, ca, hb, cb in zip(batch["ha"], batch["ca"], batch["hb"], batch["cb"], strict=True)
            ]
            yield batch.loc[np.array(good, bool), ["a", "b"]]

    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"), F.col("counts").alias("ca"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"), F.col("counts").alias("cb"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "ha", "ca", "hb", "cb")
    return joined.mapInPandas(check, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and label (the least node of its component), for all nodes that have a link.

    Labels take the least one among neighbours and then that label's own label; each step is a written table, and only a
    count of changes comes back.
    """
    edges = written(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("next"), F.col("label").alias("was"))
        of_label = labels.select(F.col("node").alias("next"), F.col("label").alias("beyond"))
        jumped = lower.join(of_label, "next", "left").select("node", F.least("next", "beyond").alias("label"), "was")
        step = written(jumped, "labels")
        labels = step.select("node", "label")
        if not step.where("label <> was").limit(1).count():
            return labels


def _leader_pairs(members: DataFrame, order: Column) -> DataFrame:
    """Each member with its bucket's leader, where their classes differ. Leaders are pre-aggregated; buckets are not gathered."""
    leader = members.groupBy("key").agg(F.min(F.struct(order.alias("o"), "node", "label")).alias("l"))
    joined = members.join(leader, "key").where(F.col("label") != F.col("l.label"))
    return joined.select(F.least("node", "l.node").alias("a"), F.greatest("node", "l.node").alias("b")).distinct()


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their classes, of buckets that hold more than one class."""
    named = members.join(labels, "node", "left").select("key", "node", "popularity", F.coalesce("label", "node").alias("label"))
    several = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
    return named.join(several, "key", "left_semi")


def _against_hub(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of each hub and node: sizes of both, how many of the hub's elements the node lacks, where they differ, and whether counts vary.

    ``differing`` holds what the node has beside the hub, and, from ``LACKING`` on, what it lacks of it.
    """
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for hub, own, counts, hub_counts in zip(batch["hh"], batch["nh"], batch["nc"], batch["hc"], strict=True):
                mine, its = np.frombuffer(own, np.uint32), np.frombuffer(hub, np.uint32)
                beside = np.setdiff1d(mine, its, assume_unique=True).astype(np.int64)
                lacking = np.setdiff1d(its, mine, assume_unique=True).astype(np.int64)
                rows.append((len(mine), len(its), len(lacking), np.concatenate([beside, lacking + LACKING]), bool(counts or hub_counts)))
            columns = ("size", "hub_size", "lacks", "differing", "weighted")
            yield batch[["hub", "node"]].assign(**dict(zip(columns, zip(*rows, strict=True), strict=True)))

    of_hub = sets.select(F.col("node").alias("hub"), F.col("hashes").alias("hh"), F.col("counts").alias("hc"))
    of_node = sets.select("node", F.col("hashes").alias("nh"), F.col("counts").alias("nc"))
    joined = pairs.join(of_node, "node").join(of_hub, "hub").select("hub", "node", "hh", "hc", "nh", "nc")
    return joined.mapInPandas(compare, "hub long, node long, size long, hub_size long, lacks long, differing array<long>, weighted boolean")


def _shares(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """hub, node and the other columns, with each element of the node's set and its share of all counts."""
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            elements = [np.frombuffer(h, np.uint32).astype(np.int64) for h in batch.pop("hashes")]
            counts = [np.frombuffer(c, np.uint32) if c else np.ones(len(e)) for c, e in zip(batch.pop("counts"), elements, strict=True)]
            yield batch.assign(elements=elements, shares=[c / c.sum() for c in counts])

    kinds = "node long, hub long, minor boolean, label long, weighted boolean, elements array<long>, shares array<double>"
    rows = nodes.join(sets, "node").select("node", "hub", "minor", "label", "weighted", "hashes", "counts").mapInPandas(compute, kinds)
    zipped = F.explode(F.arrays_zip("elements", "shares")).alias("e")
    return rows.select("node", "hub", "minor", "label", "weighted", zipped).select(
        "node", "hub", "minor", "label", "weighted", F.col("e.elements").alias("element"), F.col("e.shares").alias("share")
    )


def _rarest_first(elements: DataFrame) -> tuple[DataFrame, Window]:
    """With the number of nodes of the hub that have an element, and the order in which a node's elements come."""
    held = elements.groupBy("hub", "element").agg(F.count(F.lit(1)).alias("nodes"))
    return elements.join(held, ["hub", "element"]), Window.partitionBy("hub", "node").orderBy("nodes", "element")


def _meeting(minors: DataFrame, others: DataFrame, possible: Column) -> DataFrame:
    """Pairs of a minor node (u) and another of a different class (v) that have an element in common, as far as they can be a link."""
    met = minors.alias("u").join(others.alias("v"), ["hub", "element"]).where((F.col("u.label") != F.col("v.label")) & possible)
    return met.select(F.col("u.node").alias("x"), F.col("v.node").alias("y"))


def _rest_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Every pair of different classes of a bucket that can still be a link.

    All members were compared with the bucket's hub h, so a minor node (one outside the hub's class) has no link to it. Write d(x) for the
    elements in which x and h differ. Two sets of counts one share |h| - lacks(x) - lacks(y) + |d(x) & d(y)| elements, and a link needs
    0.8 / 1.8 (|x| + |y|) of them. If d(x) and d(y) share nothing, y is no nearer to x than h is; so a minor node has links
    only to nodes that share at least t >= 1 elements of d, where t follows from the sizes. With one order of elements for all,
    rarest first, two sets that share t elements also share one among the first |d| - t + 1 of each: only those are
    joined. t is the least over all possible partners.

    Where counts vary, a link needs shared elements with 0.8 of the counts of either side, as the probability Jaccard similarity is at most the sum
    of the smaller shares. So both have a shared element among the rarest that make up 0.2. Pairs within a class need no comparison.
    """
    hub = members.groupBy("key").agg(F.min(F.struct(-F.col("popularity"), "node", "label")).alias("h"))
    grouped = members.join(hub, "key").select(F.col("h.node").alias("hub"), "node", "label", F.col("h.label").alias("of_hub")).distinct()
    stats = _against_hub(grouped.select("hub", "node"), sets)
    full = written(grouped.join(stats, ["hub", "node"]).withColumn("minor", F.col("label") != F.col("of_hub")), "open")
    part = SIMILARITY / (1 + SIMILARITY)
    burden = part * F.col("size") + F.col("lacks")
    least = full.groupBy("hub").agg(F.min(burden).alias("least"), F.min(F.when(F.col("minor"), burden)).alias("least_minor"))
    needed = burden - F.col("hub_size") - 1e-6

    def kept(partner: str) -> Column:
        return F.col("n") - F.greatest(F.ceil(needed + F.col(partner)), F.lit(1)) + 1

    plain = full.where(~F.col("weighted")).join(least.where("least_minor is not null"), "hub")
    lengths = plain.withColumns({"n": F.size("differing"), "burden": burden}).select(
        "hub", "node", "label", "minor", "weighted", "size", "n", (F.col("burden") - F.col("hub_size") / 2).alias("share"),
        kept("least").alias("as_minor"), kept("least_minor").alias("as_other"), F.explode("differing").alias("element"),
    )
    ordered, order = _rarest_first(lengths)
    placed = written(ordered.withColumn("place", F.row_number().over(order)).where("nodes > 1 and place <= greatest(as_minor, as_other)"), "prefixes")
    # From the first shared element on, no more can be shared than what follows in both; and no more than the smaller set has.
    follow = 1 + F.least(F.col("u.n") - F.col("u.place"), F.col("v.n") - F.col("v.place"))
    fit = F.least("u.size", "v.size") >= SIMILARITY * F.greatest("u.size", "v.size")
    enough = fit & (follow >= F.col("u.share") + F.col("v.share") - 1e-6)
    alike = _meeting(placed.where("minor and place <= as_minor"), placed.where("place <= as_other"), enough)

    uneven = full.join(full.where("weighted").select("hub").distinct(), "hub", "left_semi")
    uneven = uneven.join(least.where("least_minor is not null").select("hub"), "hub", "left_semi")
    ordered, order = _rarest_first(_shares(uneven.select("node", "hub", "minor", "label", "weighted"), sets))
    before = F.coalesce(F.sum("share").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    first = written(ordered.withColumn("before", before).where(F.col("before") <= 1 - SIMILARITY + 1e-6).where("nodes > 1"), "prefixes")
    uneven_pairs = _meeting(first.where("minor"), first, F.col("u.weighted") | F.col("v.weighted"))
    pairs = alike.select("x", "y").unionAll(uneven_pairs.select("x", "y"))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id and class_id, the least doc_id of the class; one row per document."""
    sketched = written(sketches(documents), "sketches")
    texts = written(
        sketched.where(F.size("bands") > 0).groupBy("text_key").agg(
            F.min("doc_id").alias("node"), F.first("bands").alias("bands")
        ),
        "texts",
    )
    named = texts.where("node is not null")
    rows = named.select("node", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(rows.join(shared, "key"), "buckets")
    # Nodes that share buckets with many make the best leaders: in a group of copies, what all were copied from.
    nodes = written(members.groupBy("node").agg(F.sum("n").alias("popularity")), "nodes")
    members = members.select("key", "node").join(nodes, "node")
    small = nodes.count() <= MOST_BROADCAST_ROWS
    ids = F.broadcast(nodes.select("node")) if small else nodes.select("node")
    texts_of = documents.select(F.col("doc_id").cast("long").alias("node"), whole_text().alias("text")).join(ids, "node", "left_semi")
    sets = written(shingle_sets(texts_of), "sets")

    alone = members.withColumn("label", F.col("node"))
    links = written(verified(_leader_pairs(alone, -F.col("popularity")), sets), "links")
    labels = components(links)
    still = written(_open(members, labels), "open")
    if still.limit(1).count():
        more = written(verified(_rest_pairs(still, sets), sets), "links")
        if more.limit(1).count():
            labels = components(links.unionAll(more))

    classes = texts.select("text_key", "node").join(labels, "node", "left").select("text_key", F.coalesce("label", "node").alias("class_id"))
    found = sketched.select("doc_id", "text_key").join(classes, "text_key", "left")
    return found.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def keep_first(documents: DataFrame) -> DataFrame:
    """One document of each class with all its columns: the one with the least doc_id; rows without an id stay."""
    first = near_duplicates(documents).where("doc_id = class_id").select(F.col("class_id").alias("__first")).distinct()
    rows = documents.join(first, F.col("doc_id").cast("long") == F.col("__first"), "left_semi")
    return rows.unionByName(documents.where("doc_id is null"))

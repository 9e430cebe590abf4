"""Approximate nearest neighbours: NN-descent builds a neighbour graph, queries walk it greedily from node to node.

Equal vectors are one node. Nodes are divided into ranges of norms in which the longest is at most twice as long as the shortest; each
range has a scale, a graph and a walk of its own, so that long vectors neither flatten short ones nor lead walks away from them. Within a
range vectors get one more component that makes all norms equal, so that the largest inner product is the nearest point; for building and
walking they are rounded to signed bytes with a scale per vector. Final scores are computed from the original vectors in double precision.

Building. Nodes start with neighbours from blocks of a few random hyperplane trees. Then, in each round, every node's
neighbours and reverse neighbours meet at the node (a join on edges, then on vectors) and are compared with each other;
each keeps its best ``NEIGHBOURS``. Nodes with many reverse neighbours are dealt in parts of ``PART``; none is left out.
Rounds end when at most ``SETTLED`` of all list entries are new; lists only get better, so that they do end.

Searching. Each query has a beam of its best ``BEAM`` nodes per range, starts at its own place in the graph and at the best ``STARTS`` of the
range's pivots, and in every hop joins the ``VISITS`` best nodes it has not visited with their adjacency, until no beam holds a node that was
not visited. A range is left out for a query only if no vector as short as that can reach what the best pivots have. Pivots are a hashed
sample of at most ``PIVOTS`` nodes of all ranges together; they are where walks begin, no bound on what these find.

Index and search cover every row. Defined results: vectors that are null, empty, zero, of another length than most (ties: the
shorter), or that hold null or non-finite components take no part; equal scores rank by vec_id; repeated rows count as
often as they occur, and only a row's own id is left out of its result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluicebox.llm.common import written

NEAREST, QUERY_STEP = 20, 20
NEIGHBOURS, TREES, BLOCK, PART = 24, 4, 400, 64
SETTLED = 0.001  # share of new list entries in a round that is the last
BEAM, VISITS = 512, 128
PIVOTS, STARTS = 4096, 16
RANGE_EDGE = 0.7  # ranges begin at this times a power of two, away from the norms 1, 2, ... that tables are scaled to
HELD_ENTRIES = 2_000_000

Batches = Iterator[pd.DataFrame]


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, vec (array<double>) and key of the rows that take part."""
    vec = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).where("vec_id is not null and vec is not null")
    fine = rows.where(F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0))
    usual = fine.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").first()
    kept = fine.where(F.size("vec") == (usual["n"] if usual else -1))
    return kept.withColumn("key", F.md5(F.to_json("vec").cast("binary")))


def with_norms(nodes: DataFrame) -> DataFrame:
    """Adds ``length`` (binary logarithm of the norm) and ``span``, the number of its range; neither overflows for any finite vector."""
    largest = F.array_max(F.transform("vec", F.abs))
    sized = nodes.withColumn("largest", largest)
    squares = F.aggregate("vec", F.lit(0.0), lambda a, x: a + (x / F.col("largest")) * (x / F.col("largest")))
    lengths = sized.withColumn("length", F.log2(F.col("largest")) + F.log2(squares) / 2)
    return lengths.withColumn("span", F.floor(F.col("length") - F.log2(F.lit(RANGE_EDGE))).cast("int")).drop("largest")


def packed_bytes(vectors: np.ndarray) -> list[bytes]:
    """Of each vector its scale (four bytes) and its components as signed bytes."""
    scale = np.maximum(np.abs(vectors).max(axis=1), 1e-30).astype(np.float32) / np.float32(127)
    small = np.clip(np.rint(vectors / scale[:, None]), -127, 127).astype(np.int8)
    both = np.concatenate([scale[:, None].view(np.uint8), small.view(np.uint8)], axis=1)
    return [row.tobytes() for row in both]


def unpacked(codes: bytes, count: int) -> np.ndarray:
    rows = np.frombuffer(codes, np.uint8).reshape(count, -1)
    return rows[:, 4:].view(np.int8).astype(np.float32) * np.ascontiguousarray(rows[:, :4]).view(np.float32)


def _least_ids(ids: np.ndarray, keys: np.ndarray) -> pd.DataFrame:
    order = np.lexsort((ids, keys))
    ids, keys = ids[order], keys[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    start = np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
    few = np.arange(len(ids)) - start <= NEAREST
    return pd.DataFrame({"key": keys[few], "vec_id": ids[few]})


def members_of(rows: DataFrame) -> DataFrame:
    """The least ids of each key, enough for any result list; tasks keep no more of a key than that before the shuffle."""
    def few(batches: Batches) -> Batches:
        for batch in batches:
            if len(batch):
                yield _least_ids(batch["vec_id"].to_numpy(), batch["key"].to_numpy().astype(str))

    part = rows.select("key", "vec_id").mapInPandas(few, "key string, vec_id long")
    listed = part.groupBy("key").agg(F.slice(F.sort_array(F.collect_list("vec_id")), 1, NEAREST + 1).alias("members"))
    return listed.select("key", F.col("members")[0].alias("node"), "members")


def whole_groups(batches: Batches, key: str) -> Batches:
    """Batches of sorted rows, cut so that no value of ``key`` is in two of them."""
    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        cut = int(np.searchsorted(batch[key].to_numpy(), batch[key].iloc[-1]))
        rest = batch.iloc[cut:]
        if cut:
            yield batch.iloc[:cut]
    if rest is not None and len(rest):
        yield rest


def by_group(frame: DataFrame, key: str, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``work`` on batches of whole groups."""
    def run(batches: Batches) -> Batches:
        for batch in whole_groups(batches, key):
            yield work(batch)

    return frame.repartition(F.col(key)).sortWithinPartitions(key).mapInPandas(run, schema)


def _best(owner: np.ndarray, other: np.ndarray, score: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best different others of each owner, best first (ties: smaller number)."""
    order = np.lexsort((other, owner))
    owner, other, score = owner[order], other[order], score[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])
    owner, other, score = owner[new], other[new], score[new]
    order = np.lexsort((other, -score, owner))
    owner, other, score = owner[order], other[order], score[order]
    first = np.ones(len(owner), bool)
    first[1:] = owner[1:] != owner[:-1]
    start = np.maximum.accumulate(np.where(first, np.arange(len(owner)), 0)) if len(owner) else np.zeros(0, int)
    few = np.arange(len(owner)) - start < most
    return owner[few], other[few], score[few]


def _packed(owner: np.ndarray, other: np.ndarray, score: np.ndarray) -> pd.DataFrame:
    cut = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, int)
    ends = [*cut[1:], len(owner)]
    return pd.DataFrame({
        "node": owner[cut], "others": [other[a:b].tobytes() for a, b in zip(cut, ends, strict=bool(len(cut)))],
        "scores": [score[a:b].tobytes() for a, b in zip(cut, ends, strict=bool(len(cut)))],
    })


def _flat(rows: pd.DataFrame, owner: str = "node") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(x) // 8 for x in rows["others"]], np.int64)
    return (
        np.repeat(rows[owner].to_numpy(np.int64), sizes), np.frombuffer(b"".join(rows["others"]), np.int64),
        np.frombuffer(b"".join(rows["scores"]), np.float32),
    )


LISTS = "node long, others binary, scores binary"


class Pairs:
    """Candidate neighbours that a task has met, reduced to the best of each node whenever they are many."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def compare(self, ids: np.ndarray, vectors: np.ndarray, least: np.ndarray) -> None:
        score = vectors @ vectors.T
        good = score > least[:, None]
        np.fill_diagonal(good, False)
        a, b = np.nonzero(good)
        self.parts.append((ids[a], ids[b], score[a, b].astype(np.float32)))
        self.held += len(a)

    def reduced(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = self.parts or [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))]
        a, b, s = (np.concatenate(x) for x in zip(*parts, strict=True))
        differ = a != b
        return _best(a[differ], b[differ], s[differ], NEIGHBOURS)

    def settle(self) -> pd.DataFrame | None:
        """Reduces when many are held; gives them away when reducing no longer helps."""
        if self.held <= HELD_ENTRIES:
            return None
        best = self.reduced()
        self.parts, self.held = [best], len(best[0])
        if self.held > HELD_ENTRIES // 2:
            self.parts, self.held = [], 0
            return _packed(*best)
        return None


def _met(batches: Batches, key: str) -> Batches:
    """Compares all rows of each group with each other; rows hold member, code and least."""
    pairs = Pairs()
    for batch in whole_groups(batches, key):
        ids, groups = batch["member"].to_numpy(np.int64), batch[key].to_numpy()
        codes = unpacked(b"".join(batch["code"]), len(batch))
        least = batch["least"].to_numpy(np.float32)
        cut = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
        for a, b in zip(cut, [*cut[1:], len(ids)], strict=True):
            if b - a > 1:
                pairs.compare(ids[a:b], codes[a:b], least[a:b])
            if (full := pairs.settle()) is not None:
                yield full
    yield _packed(*pairs.reduced())


def merged(lists: DataFrame, most: int = NEIGHBOURS) -> DataFrame:
    return by_group(lists, "node", lambda rows: _packed(*_best(*_flat(rows), most)), LISTS)


def first_lists(nodes: DataFrame, counts: dict[int, int], width: int) -> DataFrame:
    """Neighbours from blocks of random hyperplane trees, as deep as a range has nodes; blocks that come out large are dealt by hash."""
    depths = {span: max(0, int(np.ceil(np.log2(max(1, count / (BLOCK / 2)))))) for span, count in counts.items()}
    deepest, place_of = max(depths.values(), default=0), {span: n for n, span in enumerate(sorted(counts))}
    planes = [np.random.default_rng(tree).normal(size=(width, deepest)).astype(np.float32) for tree in range(TREES)]

    def place(batches: Batches) -> Batches:
        for batch in batches:
            if not len(batch):
                continue
            codes = unpacked(b"".join(batch["code"]), len(batch))
            used = (1 << batch["span"].map(depths).to_numpy(np.int64)) - 1
            rank = batch["span"].map(place_of).to_numpy(np.int64)
            for tree in range(TREES):
                sides = ((codes @ planes[tree] > 0) @ (1 << np.arange(deepest, dtype=np.int64))).astype(np.int64) & used
                block = (sides * TREES + tree) * len(place_of) + rank
                yield pd.DataFrame({"block": block, "member": batch["node"], "code": batch["code"]})

    placed = nodes.mapInPandas(place, "block long, member long, code binary")
    sizes = placed.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    dealt = placed.join(sizes, "block").withColumn("part", F.pmod(F.xxhash64("member", "block"), F.col("parts")))
    keyed = dealt.select(F.xxhash64("block", "part").alias("group"), "member", "code", F.lit(float("-inf")).alias("least"))
    ordered = keyed.repartition(F.col("group")).sortWithinPartitions("group")
    return merged(ordered.mapInPandas(lambda batches: _met(batches, "group"), LISTS))


def edges_of(lists: DataFrame) -> DataFrame:
    """node and other, one row per edge."""
    def flat(batches: Batches) -> Batches:
        for batch in batches:
            owner, other, _ = _flat(batch)
            yield pd.DataFrame({"node": owner, "other": other})

    return lists.select("node", "others", "scores").mapInPandas(flat, "node long, other long")


def both_ways(edges: DataFrame) -> DataFrame:
    """center and member of each edge and its reverse, and the part of the center it falls into. Mutual edges come twice."""
    ways = edges.select(F.col("node").alias("center"), F.col("other").alias("member")).unionAll(
        edges.select(F.col("other").alias("center"), F.col("node").alias("member"))
    )
    parts = ways.groupBy("center").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"))
    return ways.join(parts, "center").select("center", "member", F.pmod(F.xxhash64("member", "center"), F.col("parts")).alias("part"))


def _renewed(rows: pd.DataFrame) -> pd.DataFrame:
    """The best of old lists and what was met, and in the first row how many entries of the batch are in no old list."""
    owner, other, score = _best(*_flat(rows), NEIGHBOURS)
    old_owner, old_other, _ = _flat(rows[rows["old"]])
    owners, others = np.concatenate([owner, old_owner]), np.concatenate([other, old_other])
    order = np.lexsort((others, owners))  # a pair is in each of both at most once
    owners, others = owners[order], others[order]
    stayed = int(((owners[1:] == owners[:-1]) & (others[1:] == others[:-1])).sum())
    best = _packed(owner, other, score)
    return best.assign(entered=np.where(np.arange(len(best)) == 0, len(owner) - stayed, 0))


def improve(lists: DataFrame, nodes: DataFrame) -> DataFrame:
    """One round: neighbours of each node meet, with their codes and the score that a new neighbour must beat. ``entered`` adds
    up to the number of new entries."""
    bars = lists.select("node", F.octet_length("scores").alias("n"), F.col("scores"))

    def bar(batches: Batches) -> Batches:
        for batch in batches:
            last = [np.frombuffer(s, np.float32)[-1] if n >= 4 * NEIGHBOURS else -np.inf for n, s in zip(batch["n"], batch["scores"], strict=True)]
            yield pd.DataFrame({"member": batch["node"], "least": np.array(last, float)})

    least = bars.mapInPandas(bar, "member long, least double")
    known = nodes.select(F.col("node").alias("member"), "code").join(least, "member", "left")
    met = both_ways(edges_of(lists)).join(known, "member").select(
        F.xxhash64("center", "part").alias("group"), "member", "code", F.coalesce("least", F.lit(float("-inf"))).alias("least")
    )
    ordered = met.repartition(F.col("group")).sortWithinPartitions("group")
    found = ordered.mapInPandas(lambda batches: _met(batches, "group"), LISTS)
    both = lists.withColumn("old", F.lit(True)).unionAll(found.withColumn("old", F.lit(False)))
    return by_group(both, "node", _renewed, f"{LISTS}, entered long")


def build_graph(nodes: DataFrame, counts: dict[int, int], width: int) -> DataFrame:
    """The neighbour lists when NN-descent has settled. Neighbours of neighbours stay in their range, as the first lists do."""
    lists = written(first_lists(nodes, counts, width), "graph")
    known = nodes.select("node", "code")
    while True:
        better = written(improve(lists, known), "graph")
        lists = better.select("node", "others", "scores")
        counts = better.select(F.sum("entered").alias("new"), F.sum(F.octet_length("others") / 8).alias("all")).first()
        if (counts["new"] or 0) <= SETTLED * (counts["all"] or 0):
            return lists


def adjacency_of(lists: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, ids and codes of neighbours and reverse neighbours, in rows of at most about ``PART``."""
    ways = both_ways(edges_of(lists)).join(nodes.select(F.col("node").alias("member"), "code"), "member")
    packed = ways.groupBy("center", "part").agg(F.collect_set(F.struct("member", "code")).alias("list"))

    def pack(batches: Batches) -> Batches:
        for batch in batches:
            ids = [np.array([x["member"] for x in row], np.int64).tobytes() for row in batch["list"]]
            yield pd.DataFrame({"node": batch["center"], "ids": ids, "codes": [b"".join(x["code"] for x in row) for row in batch["list"]]})

    return packed.mapInPandas(pack, "node long, ids binary, codes binary")


STATE = "node long, code binary, others binary, scores binary, visited binary, next array<long>, least double"


def _advance(rows: pd.DataFrame) -> pd.DataFrame:
    """Of each query: its beam and what a hop found, merged, and the nodes to visit next, which count as visited."""
    queries = rows["node"].to_numpy(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], queries[1:] != queries[:-1]]))
    codes, others, scores, visits = (rows[c].tolist() for c in ("code", "others", "scores", "visited"))
    out = []
    for a, b in zip(cut, [*cut[1:], len(queries)], strict=True):
        own = next(i for i in range(a, b) if codes[i] is not None)
        seen = np.frombuffer(visits[own], np.int64)
        other = np.frombuffer(b"".join(others[a:b]), np.int64)
        score = np.frombuffer(b"".join(scores[a:b]), np.float32)
        _, other, score = _best(np.zeros(len(other), np.int64), other, score, BEAM)
        chosen = other[~np.isin(other, seen)][:VISITS]
        least = float(score[-1]) if len(score) >= BEAM else float("-inf")
        out.append((int(queries[a]), codes[own], other.tobytes(), score.tobytes(), np.concatenate([seen, chosen]).tobytes(), chosen, least))
    return pd.DataFrame(out, columns=["node", "code", "others", "scores", "visited", "next", "least"])


class Pivots:
    """Sampled nodes of every range, held by all tasks: where walks begin, and what a range has to reach."""

    def __init__(self, nodes: DataFrame, counts: dict[int, int], longest: dict[int, float]) -> None:
        each = max(1, PIVOTS // max(1, len(longest)))
        shares = [(span, min(1.0, 4.0 * each / count)) for span, count in counts.items()]
        sampled = nodes.join(F.broadcast(nodes.sparkSession.createDataFrame(shares, "span int, share double")), "span")
        chance = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / float(1 << 30)
        order = Window.partitionBy("span").orderBy(F.xxhash64("node"), "node")  # over some four times ``each`` rows of a range
        few = sampled.where(chance < F.col("share")).withColumn("at", F.row_number().over(order)).where(F.col("at") <= each)
        rows = few.select("node", "span", "code", "vec", "length").collect()
        self.longest = longest
        self.ids, self.spans = (np.array([r[c] for r in rows], np.int64) for c in ("node", "span"))
        self.codes = unpacked(b"".join(r["code"] for r in rows), len(rows))
        self.lengths = np.array([r["length"] for r in rows])
        self.units = np.array([r["vec"] for r in rows]) if rows else np.zeros((0, 0))
        largest = np.abs(self.units).max(axis=1, keepdims=True)
        self.units = self.units / largest
        self.units = self.units / np.sqrt((self.units**2).sum(1, keepdims=True))
        self.top = max(longest.values(), default=0.0)

    def spans_for(self, unit: np.ndarray) -> list[int]:
        """Ranges that may hold one of the nearest: the others' longest vector stays below what enough pivots reach."""
        scores = np.sort(self.units @ unit * np.exp2(self.lengths - self.top))[::-1]
        bar = scores[NEAREST] if len(scores) > NEAREST else -np.inf  # one more, as the query may be a pivot itself
        return [span for span, length in self.longest.items() if np.exp2(length - self.top) >= bar - 1e-9]

    def starts(self, span: int, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = np.flatnonzero(self.spans == span)
        scores = self.codes[own] @ asked
        best = np.argsort(-scores, kind="stable")[:STARTS]
        return self.ids[own[best]], scores[best].astype(np.float32)


WALKERS = "query long, span int, code binary, others binary, scores binary"


def walkers_of(queries: DataFrame, pivots: Pivots) -> DataFrame:
    """A walker per query (node, vec, span, code, asked) and range that it has to look into, with its first nodes and their scores."""
    def begin(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for node, vec, own, code, asked in zip(*(batch[c] for c in ("node", "vec", "span", "code", "asked")), strict=True):
                unit = np.asarray(vec, float)
                unit = unit / np.abs(unit).max()
                unit = unit / np.sqrt((unit**2).sum())
                question = unpacked(asked, 1)[0]
                for span in pivots.spans_for(unit):
                    ids, scores = pivots.starts(span, question)
                    if span == own and node not in ids:
                        ids, scores = np.append(ids, node), np.append(scores, unpacked(code, 1)[0] @ question)
                    out.append((node, span, asked, ids.astype(np.int64).tobytes(), scores.astype(np.float32).tobytes()))
            yield pd.DataFrame(out, columns=["query", "span", "code", "others", "scores"])

    return queries.mapInPandas(begin, WALKERS).withColumn("node", F.monotonically_increasing_id())


def walk(walkers: DataFrame, adjacency: DataFrame) -> DataFrame:
    """The beam of each walker (node, code, others, scores) after greedy search from its first nodes."""
    def begin(batches: Batches) -> Batches:
        for batch in batches:
            first = [np.frombuffer(x, np.int64) for x in batch["others"]]
            yield batch.assign(visited=batch["others"], next=first, least=float("-inf"))

    def expand(batches: Batches) -> Batches:
        for batch in batches:
            found = []
            for ids, codes, query, bar in zip(batch["ids"], batch["codes"], batch["code"], batch["least"], strict=True):
                ids = np.frombuffer(ids, np.int64)
                score = unpacked(codes, len(ids)) @ unpacked(query, 1)[0]
                good = score > bar
                found.append((ids[good].tobytes(), score[good].tobytes()))
            yield pd.DataFrame({"node": batch["query"], "others": [x for x, _ in found], "scores": [s for _, s in found]})

    state = walkers.select("node", "code", "others", "scores").mapInPandas(begin, STATE)
    while True:
        state = written(state, "beam")
        if not state.where(F.size("next") > 0).count():
            return state
        frontier = state.select(F.col("node").alias("query"), "code", "least", F.explode("next").alias("node"))
        met = frontier.join(adjacency, "node").select("query", "code", "least", "ids", "codes").mapInPandas(expand, LISTS)
        none = F.lit(None).cast("binary")
        more = met.select("node", none.alias("code"), "others", "scores", none.alias("visited"))
        state = by_group(state.select("node", "code", "others", "scores", "visited").unionAll(more), "node", _advance, STATE)


def nearest(vectors: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found for each row whose id is divisible by ``QUERY_STEP``."""
    rows = valid_vectors(vectors)
    keys = written(members_of(rows), "nodes")
    empty = "query_id long, rank int, vec_id long, score double"
    one = rows.join(keys.select("key", F.col("node").alias("vec_id")), ["key", "vec_id"], "left_semi").dropDuplicates(["vec_id", "key"])
    placed = written(with_norms(one.select(F.col("vec_id").alias("node"), "vec")), "ranges")
    ranges = placed.groupBy("span").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest"), F.first(F.size("vec")).alias("width")).collect()
    if not ranges:  # at most one row per power of two
        return vectors.sparkSession.createDataFrame([], empty)
    counts, longest, width = {r["span"]: r["n"] for r in ranges}, {r["span"]: r["longest"] for r in ranges}, ranges[0]["width"] + 1

    def code(batches: Batches) -> Batches:
        for batch in batches:
            if not len(batch):
                continue
            x = np.array(batch["vec"].tolist(), float).reshape(len(batch), width - 1)
            unit = x / np.abs(x).max(axis=1, keepdims=True)
            unit = unit / np.sqrt((unit * unit).sum(1, keepdims=True))
            share = np.exp2(batch["length"].to_numpy() - batch["span"].map(longest).to_numpy())  # of the range's longest norm
            last = np.sqrt(np.maximum(0.0, 1 - share * share))
            inside = packed_bytes(np.column_stack([unit * share[:, None], last]))
            asked = packed_bytes(np.column_stack([unit, np.zeros(len(unit))]))
            yield batch.assign(code=inside, asked=asked)

    nodes = written(placed.mapInPandas(code, "node long, vec array<double>, length double, span int, code binary, asked binary"), "codes")
    asking = rows.where(F.pmod("vec_id", F.lit(QUERY_STEP)) == 0).join(keys.select("key", "node"), "key").select(F.col("vec_id").alias("query_id"), "node")
    asked = written(asking, "asking")
    graph = build_graph(nodes.select("node", "code", "span"), counts, width)
    adjacency = written(adjacency_of(graph, nodes.select("node", "code")), "adjacency")
    queries = nodes.join(asked.select("node").distinct(), "node").select("node", "vec", "span", "code", "asked")
    walkers = written(walkers_of(queries, Pivots(nodes, counts, longest)), "walkers")
    beams = walk(walkers, adjacency).select("node", "others", "scores").join(walkers.select("node", "query"), "node")

    pairs = edges_of(beams.select(F.col("query").alias("node"), "others", "scores"))
    left, right = nodes.select("node", F.col("vec").alias("x")), nodes.select(F.col("node").alias("other"), F.col("vec").alias("y"))
    scored = pairs.join(right, "other").join(left, "node").mapInPandas(_exact, "node long, other long, score double")
    listed = scored.join(keys.select(F.col("node").alias("other"), "members"), "other").select("node", "score", F.explode("members").alias("vec_id"))
    # One more than wanted, as a query leaves out itself.
    best = by_group(listed, "node", _top_members, "node long, vec_id long, score double")
    lists = best.groupBy("node").agg(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id")).alias("found"))
    own = asked.join(lists, "node").select(
        "query_id", F.slice(F.sort_array(F.filter("found", lambda f: f["vec_id"] != F.col("query_id"))), 1, NEAREST).alias("found")
    )
    each = own.select("query_id", F.posexplode("found").alias("at", "f"))
    return each.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"), (-F.col("f.s")).alias("score"))


def _exact(batches: Batches) -> Batches:
    for batch in batches:
        x, y = (np.array(batch[c].tolist(), float).reshape(len(batch), -1) for c in ("x", "y"))
        yield pd.DataFrame({"node": batch["node"], "other": batch["other"], "score": (x * y).sum(1)})


def _top_members(rows: pd.DataFrame) -> pd.DataFrame:
    ordered = rows.sort_values(["node", "score", "vec_id"], ascending=[True, False, True], kind="stable")
    return ordered[ordered.groupby("node").cumcount() <= NEAREST][["node", "vec_id", "score"]]

"""Sharding by a hierarchical weighted hash tree (law ``key``).

A row descends region, rack and shard. At each level every child draws a weighted hash time, and the earliest child is
taken. The time of a shard is exponential with its weight as rate, drawn from the row's key and the shard's path; the
time of a rack or region is the earliest below it, again exponential with the summed weight. So raising a weight or
adding a shard can only make times in that subtree earlier: rows move into it and nowhere else, and a row that moves
goes to the shard that changed.

Defined results: the key is doc_id as text, a null id counts as the empty text; a null text has size 1 and the crc32 of
no bytes; rows with equal ids share a shard, whatever their texts; equal rows take consecutive slots. Other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DIGITS = 8  # hexadecimal digits of a draw: four draws per digest
PER_DIGEST = 32 // DIGITS
SLOT_DIGITS = 3  # rows of a shard are numbered in 16 ** 3 parts


@dataclass(frozen=True)
class Shard:
    """A leaf: its number, the path region/rack/shard, and its weight."""

    number: int
    region: int
    rack: int
    place: int
    weight: float = 1.0


def even_tree(shards: int, regions: int = 2, racks: int = 2) -> list[Shard]:
    """Shards dealt in turn to regions and racks; one more shard leaves all other paths as they are."""
    spots = regions * racks
    return [Shard(n, n % regions, n // regions % racks, n // spots) for n in range(shards)]


def _draws(key: Column, tree: list[Shard]) -> dict[int, Column]:
    """The weighted hash time of each shard, with one digest for four shards of a rack."""
    times = {}
    for shard in tree:
        path = f"/{shard.region}/{shard.rack}/{shard.place // PER_DIGEST}"
        digest = F.md5(F.concat(key, F.lit(path)).cast("binary"))
        part = F.substring(digest, shard.place % PER_DIGEST * DIGITS + 1, DIGITS)
        uniform = (F.conv(part, 16, 10).cast("double") + 0.5) / float(16**DIGITS)
        times[shard.number] = -F.ln(uniform) / F.lit(shard.weight)
    return times


def _earliest(times: list[Column]) -> Column:
    return F.least(*times) if len(times) > 1 else times[0]


def _descend(times: dict[int, Column], tree: list[Shard]) -> Column:
    """Region, then rack, then shard, each the child with the earliest time (ties: first in order)."""
    def choose(children: list[tuple[Column, Column]]) -> Column:
        first = _earliest([time for time, _ in children])
        chosen = children[-1][1]
        for time, below in reversed(children[:-1]):
            chosen = F.when(time == first, below).otherwise(chosen)
        return chosen

    def level(members: list[Shard], names: tuple[str, ...]) -> Column:
        if not names:
            return choose([(times[s.number], F.lit(s.number)) for s in members])
        groups: dict[int, list[Shard]] = {}
        for s in members:
            groups.setdefault(getattr(s, names[0]), []).append(s)
        return choose([(_earliest([times[s.number] for s in g]), level(g, names[1:])) for _, g in sorted(groups.items())])

    return level(tree, ("region", "rack"))


def assign(rows: DataFrame, key: Column, tree: list[Shard], grown: list[Shard] | None = None) -> DataFrame:
    """Adds ``shard`` and, with a second tree, ``grown_shard``. Narrow: no shuffle, no state."""
    leaves = {s.number: s for s in [*tree, *(grown or [])]}
    times = {n: f"__time_{n}" for n in leaves}
    drawn = rows.withColumn("__key", key).withColumns(
        {times[n]: c for n, c in _draws(F.col("__key"), list(leaves.values())).items()}
    )
    columns = {n: F.col(name) for n, name in times.items()}
    placed = drawn.withColumn("shard", _descend(columns, tree))
    if grown:
        placed = placed.withColumn("grown_shard", _descend(columns, grown))
    return placed.drop("__key", *times.values())


def number_slots(placed: DataFrame, order: list[str]) -> DataFrame:
    """Gapless slots from 0 in each shard.

    Rows are numbered within fixed parts of a shard by digest, so no task ever holds a whole shard; the sizes of the
    parts, at most 4,096 per shard, give each part its first slot.
    """
    split = placed.withColumn("__part", F.substring(F.md5(F.coalesce(F.col(order[0]).cast("string"), F.lit("")).cast("binary")), 1, SLOT_DIGITS))
    sizes = split.groupBy("shard", "__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = W.partitionBy("shard").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("shard", "__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__first"))
    inside = W.partitionBy("shard", "__part").orderBy(*order)
    numbered = split.withColumn("__row", F.row_number().over(inside))
    joined = numbered.join(starts, ["shard", "__part"])
    return joined.withColumn("slot", (F.col("__first") + F.col("__row") - 1).cast("long")).drop("__part", "__first", "__row")


def shard_documents(documents: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and the shard with one more leaf."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents.select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).cast("long").alias("text_crc32")
    )
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    placed = assign(rows, key, even_tree(shards), even_tree(shards + 1))
    slots = number_slots(placed, ["doc_id", "text_crc32", "size"])
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.col("grown_shard").cast("int").alias("grown_shard"),
    )


def write_shards(documents: DataFrame, path: str, shards: int = 16) -> None:
    """The documents as one folder per shard; a hot shard is written by many tasks."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    placed = assign(documents.drop("shard"), key, even_tree(shards))
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)

"""Exact removal of repeated 100-byte strings by suffix sorting in shards.

1. Anchors. Each window of ``WINDOW`` bytes names its least ``GRAM``-byte string by hash, so equal windows name equal ones.
   Hashes that occur once in all distinct texts cannot belong to a repeated window; windows of the others are candidates.
2. Shards. The candidate windows of an anchor, with the bytes they need, go to one shard, so all windows that are equal
   meet. The shard follows from the least key among the texts that hold the anchor: neighbouring anchors mostly have the
   same one, and their pieces travel and are sorted as one stretch. Anchors with more than ``HOT`` places are dealt finer,
   by the bytes that a few neighbouring windows have in common.
3. Each shard sorts its pieces by external induced sorting (see ``induced``), equal pieces once; neighbours with a common
   prefix of a window or more are equal windows, and all but the earliest are repeats.
4. Repeats go back to their texts, where the bytes that they cover are removed.

Earlier means: smaller doc_id, then the hash of the text, then the start. Defined results: null texts count as empty; rows
without doc_id come last; equal rows are one document and its later copies; a copy of an earlier whole text loses all its
bytes if it has a window's length, and none otherwise; texts shorter than a window stay. Texts are never cut. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import written
from sluicebox.llm.induced import suffixes_with_prefixes
from sluicebox.llm.near_dup import Powers, mix

WINDOW, GRAM = 100, 40
SPAN = WINDOW - GRAM + 1  # grams in a window
HOT = 200
FINE = 8  # windows of a hot anchor that are dealt together
CHUNK_BYTES = 1_000_000
BLOCK = 1 << 15  # windows whose anchors are found at a time
SHARD_BYTES = 4_000_000
PLACE_BITS = 24
MOST_BROADCAST_ROWS = 1_000_000  # of eight bytes each; beyond it the same join shuffles
LAST_ID = (1 << 63) - 1


def _least_places(hashed: np.ndarray, windows: int) -> np.ndarray:
    """Of each window, the place of its gram with the least hash. Windows are taken in stretches, so that a place within a
    stretch fits the bits it has, however long the text is."""
    places = np.empty(windows, np.int64)
    step = (1 << PLACE_BITS) - SPAN + 1
    for start in range(0, windows, step):
        here = min(step, windows - start)
        part = hashed[start : start + here + SPAN - 1]
        # The hash's upper bits with the place below: the least one is the leftmost of equal hashes.
        key = (part >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(part), dtype=np.uint64)
        width = 1
        while 2 * width <= SPAN:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        key = np.minimum(key[:here], key[SPAN - width : SPAN - width + here])
        places[start : start + here] = start + (key & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    return places


def window_anchors(texts: list[bytes], powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that name the same place: text number, first and last start, place of the gram, hash. Offsets are in
    the text. Windows are taken in blocks whose arrays stay in the processor's cache; hashes do not depend on the block."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    none = np.zeros(0, np.int64)
    if len(raw) < WINDOW:
        return none, none, none, none, none.astype(np.uint64)
    up, down = powers.upto(BLOCK + WINDOW)
    windows, fitting = len(raw) - WINDOW + 1, np.maximum(sizes - WINDOW + 1, 0)
    place, hashes, opens = np.empty(windows, np.int64), np.empty(windows, np.uint64), np.zeros(windows, bool)
    opens[begins[fitting > 0]] = True
    for start in range(0, windows, BLOCK):
        here = min(BLOCK, windows - start)
        part = raw[start : start + here + WINDOW - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        hashed = mix((sums[GRAM:] - sums[:-GRAM]) * down[: len(part) - GRAM + 1])
        least = _least_places(hashed, here)
        place[start : start + here] = least + start
        opens[start + 1 : start + here] |= least[1:] != least[:-1]
        opens[start] |= not start or place[start] != place[start - 1]
        new = np.flatnonzero(opens[start : start + here])
        hashes[start + new] = hashed[least[new]]
    lo = np.flatnonzero(opens)
    hi = np.append(lo[1:], windows) - 1
    t = np.searchsorted(begins, lo, "right") - 1
    last = (begins + fitting)[t] - 1
    fits = lo <= last  # windows over the end of a text are none
    lo, hi, t = lo[fits], np.minimum(hi, last)[fits], t[fits]
    return t, lo - begins[t], hi - begins[t], place[lo] - begins[t], mix(hashes[lo])


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_BYTES:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, texts[start:]


def _groups(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
    for a, b in zip(cut, [*cut[1:], len(keys)], strict=True):
        yield int(keys[order[a]]), order[a:b]


def anchor_rows(texts: DataFrame, buckets: int) -> DataFrame:
    """Per bucket and chunk: the texts' keys, how many anchors each has here, and the anchors' hashes and places, packed."""
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = Powers()
        for batch in batches:
            keys = batch["key"].to_numpy(np.int64)
            for start, part in _chunks(batch["raw"].tolist()):
                text, _, _, place, hashed = window_anchors(part, powers)
                rows = []
                for bucket, at in _groups((hashed >> np.uint64(32)).astype(np.int64) % buckets):
                    named, count = np.unique(text[at], return_counts=True)
                    rows.append((
                        bucket, keys[start + named].tobytes(), count.astype(np.uint32).tobytes(),
                        hashed[at].astype(np.uint32).tobytes(), place[at].astype(np.uint32).tobytes(),
                    ))
                yield pd.DataFrame(rows, columns=["bucket", "keys", "counts", "hashes", "places"])

    return texts.select("key", "raw").mapInPandas(compute, "bucket int, keys binary, counts binary, hashes binary, places binary")


def _shared_anchors(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: per text the places of anchors whose hash has several places, which are hot, and what deals the others."""
    def joined(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(rows[name]), kind)

    key = np.repeat(joined("keys", np.int64), joined("counts", np.uint32))
    hashed, place = joined("hashes", np.uint32), joined("places", np.uint32)
    order = np.lexsort((place, key, hashed))
    key, hashed, place = key[order], hashed[order], place[order]
    own = np.ones(len(key), bool)  # equal texts have equal keys, and their anchors count once
    own[1:] = (hashed[1:] != hashed[:-1]) | (key[1:] != key[:-1]) | (place[1:] != place[:-1])
    key, hashed, place = key[own], hashed[own], place[own]
    _, first, group, count = np.unique(hashed, return_index=True, return_inverse=True, return_counts=True)
    least = key[first][group]  # within a hash, keys ascend
    several = count[group] > 1
    key, place, hot, least = key[several], place[several], count[group][several] > HOT, least[several]
    deals = np.where(hot, 0, mix(least.astype(np.uint64)) >> np.uint64(32)).astype(np.uint32)
    found = [(k, place[at].tobytes(), hot[at].tobytes(), deals[at].tobytes()) for k, at in _groups(key)]
    return pd.DataFrame(found, columns=["key", "places", "hot", "deals"])


def _pieces(raw: bytes, runs: list[np.ndarray], shared: np.ndarray, hot: np.ndarray, deals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window and dealing hash of each piece of one text."""
    lo, hi, place, hashed = runs
    at = np.searchsorted(shared, place)
    at = np.minimum(at, len(shared) - 1)
    mine = shared[at] == place
    lo, hi, place, hashed, warm, owner = lo[mine], hi[mine], place[mine], hashed[mine], hot[at[mine]], deals[at[mine]]
    first, last, deal = [lo[~warm]], [hi[~warm]], [owner[~warm].astype(np.uint64) << np.uint64(16)]
    for a, b, p, h in zip(lo[warm], hi[warm], place[warm], hashed[warm], strict=True):
        # Pieces end at fixed distances from the anchor: the windows after a place of the grid, up to the next place ``top``.
        edges = [a, *range(int(p) - (int(p) - int(a)) // FINE * FINE + 1, int(b) + 1, FINE), int(b) + 1]
        for x, y in zip(edges[:-1], edges[1:], strict=True):
            if x < y:
                # What all windows of a whole step share deals the piece, and a part of a step alike.
                top = int(p) - (int(p) - int(x)) // FINE * FINE
                core = raw[top : top + WINDOW - FINE + 1]
                code = int.from_bytes(hashlib.blake2b(core, digest_size=8, key=int(h).to_bytes(8, "little")).digest(), "little")
                first.append([x]), last.append([y - 1]), deal.append([code ^ (int(p) - top)])
    return np.concatenate(first).astype(np.int64), np.concatenate(last).astype(np.int64), np.concatenate([np.asarray(d, np.uint64) for d in deal])


PIECE = "shard int, owner binary, first binary, windows binary, follows binary, bytes binary"


def piece_rows(candidates: DataFrame, shards: int) -> DataFrame:
    """Pieces packed per shard and chunk; one that follows another of its text brings only the bytes that are new."""
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = Powers()
        for batch in batches:
            for start, part in _chunks(batch["raw"].tolist()):
                rows = batch.iloc[start : start + len(part)]
                text, lo, hi, place, hashed = window_anchors(part, powers)
                cut = np.searchsorted(text, np.arange(len(part) + 1))
                owner, first, last, deal = [], [], [], []
                for i, (shared, hot, deals) in enumerate(zip(rows["places"], rows["hot"], rows["deals"], strict=True)):
                    marks = np.frombuffer(shared, np.uint32).astype(np.int64)
                    order = np.argsort(marks, kind="stable")
                    runs = [x[cut[i] : cut[i + 1]] for x in (lo, hi, place, hashed)]
                    f, e, d = _pieces(part[i], runs, marks[order], np.frombuffer(hot, bool)[order], np.frombuffer(deals, np.uint32)[order])
                    owner.append(np.full(len(f), i)), first.append(f), last.append(e), deal.append(d)
                if not owner:
                    continue
                owner, first, last, deal = (np.concatenate(x) for x in (owner, first, last, deal))
                ids, keys = rows["doc_id"].to_numpy(np.int64), rows["key"].to_numpy(np.int64)
                out = []
                for shard, at in _groups((deal >> np.uint64(16)).astype(np.int64) % shards):
                    at = at[np.lexsort((first[at], owner[at]))]
                    o, f, e = owner[at], first[at], last[at]
                    follows = np.zeros(len(at), bool)
                    follows[1:] = (o[1:] == o[:-1]) & (f[1:] == e[:-1] + 1)
                    new = [part[x][a:b] for x, a, b in zip(o.tolist(), (f + follows * (WINDOW - 1)).tolist(), (e + WINDOW).tolist(), strict=True)]
                    names = np.stack([ids[o], keys[o]], axis=1)
                    out.append((
                        shard, names.tobytes(), f.tobytes(), (e - f + 1).astype(np.uint32).tobytes(), follows.tobytes(), b"".join(new)
                    ))
                yield pd.DataFrame(out, columns=["shard", "owner", "first", "windows", "follows", "bytes"])

    return candidates.mapInPandas(compute, PIECE)


def _repeats(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one shard: the runs of repeated windows of each text."""
    names = np.frombuffer(b"".join(rows["owner"]), np.int64).reshape(-1, 2)
    first = np.frombuffer(b"".join(rows["first"]), np.int64)
    windows = np.frombuffer(b"".join(rows["windows"]), np.uint32).astype(np.int64)
    follows = np.frombuffer(b"".join(rows["follows"]), bool)
    joined = b"".join(rows["bytes"])
    ends = np.cumsum(windows + np.where(follows, 0, WINDOW - 1))
    pieces = [joined[a:b] for a, b in zip((ends - windows - WINDOW + 1).tolist(), ends.tolist(), strict=True)]
    rank = np.empty(len(pieces), np.int64)
    earliest_first = np.lexsort((first, names[:, 1], names[:, 0]))
    rank[earliest_first] = np.arange(len(pieces))
    # Equal pieces are sorted once: the earliest stands for all, and every window of the others is a repeat of its.
    seen: dict[bytes, int] = {}
    chosen, copies = [], []
    for i in earliest_first.tolist():
        if seen.setdefault(pieces[i], i) == i:
            chosen.append(i)
        else:
            copies.append(i)
    # Chosen pieces that follow each other in a text are sorted as one stretch.
    at = np.array(chosen, np.int64)  # by text and start already
    heads = np.ones(len(at), bool)
    heads[1:] = (names[at[1:]] != names[at[:-1]]).any(1) | (first[at[1:]] != first[at[:-1]] + windows[at[:-1]])
    head = np.flatnonzero(heads)
    ends = np.append(head[1:], len(at))
    stretches = [b"".join([pieces[i][: windows[i]] for i in at[a : b - 1]] + [pieces[at[b - 1]]]) for a, b in zip(head, ends, strict=True)]
    with tempfile.TemporaryDirectory() as scratch:
        falling, prefix, starts = suffixes_with_prefixes(stretches, WINDOW, scratch)
        stretch_of = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(falling)))[falling]
        offset = falling - starts[stretch_of]
        group = np.cumsum(prefix < WINDOW)
    own = at[head][stretch_of]
    valid = offset < np.add.reduceat(windows[at], head)[stretch_of]
    own, offset, group = own[valid], offset[valid], group[valid]
    # Of each group of equal windows, all but the earliest: by text and start of the piece, and the place in the text.
    opens = np.ones(len(own), bool)
    opens[1:] = group[1:] != group[:-1]
    heads = np.flatnonzero(opens)
    sizes = np.diff(heads, append=len(own))
    several = np.repeat(sizes > 1, sizes)
    own, offset, sizes = own[several], offset[several], sizes[sizes > 1]
    if len(sizes):
        heads = np.cumsum(sizes) - sizes
        level = rank[own]
        soonest = level == np.repeat(np.minimum.reduceat(level, heads), sizes)
        place = np.where(soonest, offset, len(falling))
        later = ~soonest | (place != np.repeat(np.minimum.reduceat(place, heads), sizes))
        own, offset = own[later], offset[later]
    start, size = first[own] + offset, np.ones(len(own), np.int64)
    copy = np.array(copies, np.int64)
    own, start, size = np.concatenate([own, copy]), np.concatenate([start, first[copy]]), np.concatenate([size, windows[copy]])
    out = []
    for text, at in _groups(rank_of_texts(names)[own]):
        begin, length = start[at], size[at]
        order = np.argsort(begin, kind="stable")
        begin, length = begin[order], length[order]
        new = np.flatnonzero(np.concatenate([[True], begin[1:] != begin[:-1] + length[:-1]]))
        total = np.add.reduceat(length, new)
        owner = names[own[at[0]]]
        out.append((int(owner[0]), int(owner[1]), np.stack([begin[new], total], axis=1).tobytes()))
        del text
    return pd.DataFrame(out, columns=["doc_id", "key", "repeats"])


def rank_of_texts(names: np.ndarray) -> np.ndarray:
    return np.unique(names, axis=0, return_inverse=True)[1].ravel()


def cut_repeats(raw: bytes, repeats: list[bytes]) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what remains, for runs of repeated windows."""
    runs = np.frombuffer(b"".join(repeats), np.int64).reshape(-1, 2)
    if not len(runs):
        return 0, 0, raw
    change = np.zeros(len(raw) + 1, np.int64)
    np.add.at(change, runs[:, 0], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1] - 1 + WINDOW, -1)
    gone = np.cumsum(change[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), spans, np.frombuffer(raw, np.uint8)[~gone].tobytes()


def _key(whole: Column) -> Column:
    """The first 64 bits of a text's digest, which name it in packed rows; what is a copy is told by the whole digest."""
    return F.conv(F.substring(whole, 1, 16), 16, -10).cast("long")


def _by_id(frame: DataFrame, ids: DataFrame) -> DataFrame:
    small = ids.count() <= MOST_BROADCAST_ROWS
    return frame.join(F.broadcast(ids) if small else ids, ["doc_id", "key"], "left_semi")


def remove_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, key, raw, n_removed, n_spans and kept (bytes) of the distinct texts that hold repeats; others are whole."""
    spark = documents.sparkSession
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc_id"), raw.alias("raw"))
    keyed = rows.select("doc_id", F.sha2("raw", 256).alias("whole"), "raw").withColumn("key", _key(F.col("whole")))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = anchor_rows(keyed, buckets)
    found = packed.groupBy("bucket").applyInPandas(_shared_anchors, "key long, places binary, hot binary, deals binary")
    marks = written(found, "anchors")
    firsts = keyed.groupBy("key", "whole").agg(F.min("doc_id").alias("doc_id"))
    marked = written(marks.select("key").distinct().join(firsts, "key").select("doc_id", "key"), "marked")
    # Struct lists keep the parts of a text in one order.
    parts = marks.groupBy("key").agg(F.collect_list(F.struct("places", "hot", "deals")).alias("parts"))

    def joined(name: str) -> Column:
        return F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p[name])), "")).alias(name)

    places = parts.select("key", joined("places"), joined("hot"), joined("deals"))
    texts = _by_id(keyed.drop("whole"), marked).dropDuplicates(["doc_id", "key"])
    candidates = written(texts.join(places, "key"), "candidates")
    size = candidates.select(F.sum(F.octet_length("places")).alias("n")).first()["n"] or 0
    shards = max(1, size // 4 * GRAM // SHARD_BYTES)  # about as many bytes as windows between anchors
    repeats = piece_rows(candidates, shards).groupBy("shard").applyInPandas(_repeats, "doc_id long, key long, repeats binary")
    gathered = written(repeats, "repeats").groupBy("doc_id", "key").agg(F.collect_list("repeats").alias("repeats"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [cut_repeats(r, list(x)) for r, x in zip(batch["raw"], batch["repeats"], strict=True)]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "key": batch["key"], "n_removed": [d[0] for d in done], "n_spans": [d[1] for d in done],
                "kept": [d[2] for d in done],
            })

    joined = candidates.select("doc_id", "key", "raw").join(gathered, ["doc_id", "key"])
    return joined.mapInPandas(cut, "doc_id long, key long, n_removed long, n_spans long, kept binary")


def repeat_digest(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document."""
    cut = remove_repeats(documents).select("doc_id", "key", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc_id"), F.col("doc_id").alias("shown"),
        F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("whole_sha256"),
    ).withColumn("key", _key(F.col("whole_sha256")))
    counted = written(rows.groupBy("doc_id", "shown", "key", "n_bytes", "whole_sha256").agg(F.count(F.lit(1)).alias("copies")), "texts")
    first = counted.groupBy("whole_sha256").agg(F.min("doc_id").alias("doc_id"), F.lit(True).alias("first"))
    known = counted.join(first, ["doc_id", "whole_sha256"], "left").join(cut, ["doc_id", "key"], "left")
    each = known.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    original = F.coalesce(F.col("first"), F.lit(False)) & (F.col("copy") == 1)
    copied = ~original & (F.col("n_bytes") >= WINDOW)
    return each.select(
        F.col("shown").alias("doc_id"), "n_bytes",
        F.when(copied, F.col("n_bytes")).when(original, F.coalesce("n_removed", F.lit(0))).otherwise(0).cast("long").alias("n_removed"),
        F.when(copied, 1).when(original, F.coalesce("n_spans", F.lit(0))).otherwise(0).cast("long").alias("n_spans"),
        F.when(copied, F.sha2(F.lit(""), 256)).when(original, F.coalesce("kept_sha256", "whole_sha256")).otherwise(F.col("whole_sha256")).alias("kept_sha256"),
    )

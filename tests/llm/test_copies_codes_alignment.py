"""Content sort, vector codes and token alignment against plain computations."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from text_rows import SF_ORACLE

from sluicebox.llm import alignment, codes
from sluicebox.llm.alignment import alignment_digest, default_paths
from sluicebox.llm.exact_dedup import copy_groups, keep_distinct

KIND = "doc_id long, text string"


def plain_copies(rows):
    groups = {}
    for n, (i, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), i is None, i or 0, n))
    found = []
    for raw, members in groups.items():
        first = min(members)
        for _, none, i, n in members:
            keep = None if first[1] else first[2]
            found.append((None if none else i, keep, len(members), n == first[3], hashlib.sha256(raw.encode()).hexdigest()))
    return found


def as_counter(frame):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in frame.collect())


def texts_with_a_hot_group(n):
    rng = random.Random(3)
    opening = "one opening line that very many of the texts have in common, longer than any splitter "
    rows = [(i, rng.choice(["hot text", " hot text", "hot\ttext "])) for i in range(n)]
    rows += [(n + i, opening + str(rng.randrange(n))) for i in range(n)]
    rows += [(2 * n + i, "".join(rng.choices("ab \n", k=rng.randrange(12)))) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("batch", ["7", "10000"])
def test_copies_with_a_hot_group_over_many_partitions(spark, batch):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": batch}
    before = {k: spark.conf.get(k) for k in settings}
    rows = texts_with_a_hot_group(700)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = copy_groups(spark.createDataFrame(rows, KIND).repartition(5))
        assert as_counter(found) == Counter(plain_copies(rows))
        parts = found.where("group_size >= 700").count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert parts >= 700


def test_copies_of_hard_rows(spark, documents, no_documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got, want = as_counter(copy_groups(documents)), Counter(plain_copies(rows))
    assert got == want
    kept = keep_distinct(documents)
    assert kept.columns == documents.columns and kept.count() == len({w[4] for w in want})
    assert copy_groups(no_documents).count() == 0 and keep_distinct(no_documents).columns == no_documents.columns


def plain_codes(rows):
    """Whole-table k-means on whole numbers with Python's arithmetic."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[int(np.floor(np.float64(np.float32(x)) * 1024)) for x in v] for _, v, _ in rows]
    length = len(whole[0])
    cuts = [(i * length // 4, (i + 1) * length // 4) for i in range(4)]
    books = [[v[a:b] for v in whole[:256]] for a, b in cuts]

    def nearest(part, book):
        square = [sum((x - y) ** 2 for x, y in zip(part, e)) for e in book]
        return min(range(len(book)), key=square.__getitem__), min(square)

    for _ in range(4):
        for p, (a, b) in enumerate(cuts):
            own = [nearest(v[a:b], books[p])[0] for v in whole]
            for e in set(own):
                members = [v[a:b] for v, o in zip(whole, own) if o == e]
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    found = [[nearest(v[a:b], books[p]) for p, (a, b) in enumerate(cuts)] for v in whole]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    per_label = Counter()
    for (_, _, label), f in zip(rows, found):
        per_label[label] += sum(d for _, d in f)
    return Counter(
        (i, "".join(f"{c:02x}" for c, _ in f), sum(d for _, d in f), per_label[label], digest) for (i, _, label), f in zip(rows, found)
    )


def codes_as_counter(frame):
    return Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in frame.collect())


def vectors(n, width, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(9, width)) * 3
    rows = []
    for i in range(n):
        v = centers[rng.integers(9)] + rng.normal(size=width) * 0.1 if rng.random() < 0.7 else np.round(rng.normal(size=width))
        rows.append((i if i != 5 else None, [float(np.float32(x)) for x in v * scale], None if i % 3 == 0 else i % 4))
    return rows + rows[10:20]


@pytest.mark.parametrize("n,width,scale", [(700, 8, 1.0), (40, 4, 1.0), (300, 6, 1e5)])
def test_codes(spark, monkeypatch, n, width, scale):
    monkeypatch.setattr(codes, "BLOCK", 150)
    rows = vectors(n, width, n, scale)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    assert codes_as_counter(codes.vector_codes(frame)) == plain_codes(rows)


def test_codes_by_a_salted_join(spark, monkeypatch):
    monkeypatch.setattr(codes, "MOST_BROADCAST_LABELS", 1)
    rows = vectors(60, 4, 1)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert codes_as_counter(codes.vector_codes(frame)) == plain_codes(rows)


def test_codes_of_hard_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 0.5, -0.25, 2.0], 1), (2, [1.0, 0.5, -0.25, 2.0], None), (2, [0.0] * 4, None), (None, [-1.0, 0.0, 3.0, 1e-9], 2)]
    bad = [(0, None, 1), (0, [], 1), (0, [nan, 1.0, 1.0, 1.0], 1), (0, [inf, 1.0, 1.0, 1.0], 1), (0, [None, 1.0, 1.0, 1.0], 1), (9, [1.0], 1)]
    frame = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>, label int").withColumn("code", frame_text())
    assert codes_as_counter(codes.vector_codes(frame)) == plain_codes(good)
    assert codes.vector_codes(frame.limit(0)).count() == 0
    huge = spark.createDataFrame([(1, [1e30] * 4, 1), (2, [-1e30] * 4, 1)], "vec_id long, embedding array<float>, label int")
    assert [(r.error, r.label_error) for r in codes.vector_codes(huge).collect()] == [(0, 0), (0, 0)]


def frame_text():
    from pyspark.sql import functions as F

    return F.lit("x")


@pytest.mark.parametrize("seed", range(6))
def test_trees_find_the_nearest_entries(seed):
    rng = np.random.default_rng(seed)
    points = np.floor(rng.normal(size=(1500, 5)) * 300)
    points[:400] = np.floor(rng.normal(size=5) * 2000) + rng.integers(-3, 4, size=(400, 5))
    tree = codes.grow(points)
    leaves = tree.left < 0
    assert sorted(zip(tree.low[leaves], tree.high[leaves]))[0][0] == 0 and tree.weight[0] == len(points)
    assert (tree.points[tree.place] == points).all() and (tree.total[0] == points.sum(0)).all()
    book = np.vstack([points[399::30], points[399::30], rng.integers(-900, 900, size=(30, 5))]).astype(float)
    entry, owned = codes.nearest_entries(tree, book)
    square = ((tree.points[:, None] - book[None]) ** 2).sum(2)
    assert (entry == square.argmin(1)).all() and any(tree.left[b] >= 0 for b in owned)
    plain, error = codes.plain_entries(tree.points, book)
    assert (plain == entry).all() and error == square.min(1).astype(int).tolist()
    sums = codes.sums_of(tree, book)
    for e, (n, total) in sums.items():
        rows = points[entry[tree.place] == e]
        assert n == len(rows) and total == rows.sum(0).astype(int).tolist()


HARD_TEXTS = [
    "", None, " ", "  ", "a", " a", "a ", "a  ", "a   b", "tab\t x", "x\n y\r\n  z ", "  x", "　 x  y", "don't we'll  I'm", "é😀ﬁ ñ́ 中文字",
    "🧿 \U0001f9ff\U0001f9ff x", "▁ literal", "a▁b", "<|endoftext|> <s> </s> <unk> <0x41>", "zero\0 nul", "a" * 30_000, "😀" * 3_000 + " end",
    "1234567890 12 3", "x" + " " * 500 + "y", "\x1c x\x1d y", "word " * 5_000, "​ ​ x", "é", "mixed ÀÉ́ ä",
]


def plain_alignment(tokenizers, text):
    """Ids, links and groups of a whole text, from the whole text's tokens."""
    a = tokenizers.a.encode(f" {text}", add_special_tokens=False).ids if text else []
    b = tokenizers.b.encode(text) if text else []
    spelled = [tokenizers.bytes_a[i] for i in a], [tokenizers.bytes_b[i] for i in b]
    if not text or any(b"".join(s) != f" {text}".encode() for s in spelled):
        return [], [], [], ""
    ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelled]
    links, groups, i, j, group = [], [], 0, 0, ([a[0]], [b[0]])
    while i < len(a) and j < len(b):
        links.append((a[i], b[j]))
        x, y = ends[0][i], ends[1][j]
        i, j = i + (x <= y), j + (y <= x)
        if x == y:
            groups.append(group)
            group = ([], [])
        if x <= y and i < len(a):
            group[0].append(a[i])
        if y <= x and j < len(b):
            group[1].append(b[j])
    return a, b, links, ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)


def check_alignment(frame, rows):
    tokenizers = alignment.Tokenizers(*default_paths())
    found = [(i, *plain_alignment(tokenizers, text or "")) for i, text in rows]
    docs = Counter(p for _, _, _, links, _ in found for p in set(links))
    best = {}
    for (a, _), n in docs.items():
        best[a] = max(n, best.get(a, 0))
    want = Counter(
        (i, len(a), len(b), groups.count("|"), len(links), sum(docs[p] == best[p[0]] for p in links), sum(docs[p] for p in links),
         hashlib.sha256(groups.encode()).hexdigest() if a else "")
        for i, a, b, links, groups in found
    )
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    got = Counter(tuple(r[c] for c in columns) for r in frame.collect())
    assert got - want == Counter() and got == want


@pytest.mark.parametrize("common", [1_000_000, 300, 0])
def test_alignment_of_all_texts(spark, monkeypatch, common):
    monkeypatch.setattr(alignment, "COMMON_PAIRS", common)
    documents = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    check_alignment(alignment_digest(documents), [(r.doc_id, r.text) for r in documents.collect()])


def test_alignment_of_hard_texts(spark, documents, no_documents):
    rows = [(n if n % 4 else None, text) for n, text in enumerate(HARD_TEXTS)] * 2
    rng = random.Random(8)
    rows += [(100 + n, "".join(rng.choices([" ", "  ", "a", "B", "\n", "\t", "é", "😀", "'s", "7", "!", "中", " "], k=30))) for n in range(300)]
    check_alignment(alignment_digest(spark.createDataFrame(rows, KIND)), rows)
    check_alignment(alignment_digest(documents), [(r.doc_id, r.text) for r in documents.collect()])
    assert alignment_digest(no_documents).count() == 0


def test_spans_and_decoded_bytes_give_the_same_ends():
    tokenizers = alignment.Tokenizers(*default_paths())
    units = ["é😀", "plain", "🧿🧿x", "\n\n a", "naïve"]
    aligned = tokenizers.align(units)
    assert aligned.lossless.all()
    assert (aligned.ends_a == np.cumsum(tokenizers.length_a[aligned.a])).all() and (aligned.ends_b == np.cumsum(tokenizers.length_b[aligned.b])).all()


def test_units_stay_whole_where_pieces_reach_over_blanks():
    tokenizers = alignment.Tokenizers(*default_paths())
    assert tokenizers.cut and tokenizers.units("a b  c\n d ") == ["a", "b", " c\n d "]
    tokenizers.cut = False
    assert tokenizers.units("a b  c") == ["a b  c"]

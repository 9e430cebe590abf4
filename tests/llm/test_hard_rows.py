"""Every operator over nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
from collections import Counter

import pytest
from text_rows import prose
from pyspark.sql import functions as F

import corpus_pipeline
from sluicebox.llm.chat import chat_digest, format_chats
from sluicebox.llm.decontaminate import drop_leaking, find_leaks
from sluicebox.llm.near_dup import keep_first, near_duplicates
from sluicebox.llm.neighbours import nearest
from sluicebox.llm.pieces import decode_pieces, encode_documents, piece_digest
from sluicebox.llm.quality import score_quality
from sluicebox.llm.secrets import find_secrets, mask_secrets, secret_digest
from sluicebox.llm.sharding import shard_documents
from sluicebox.llm.suffix_dedup import repeat_digest
from sluicebox.llm.toxicity import drop_toxic, score_toxicity


def ids(frame):
    return Counter(r[0] for r in frame.select("doc_id").collect())


def test_suffix_dedup(documents):
    rows = repeat_digest(documents).collect()
    assert Counter(r.doc_id for r in rows) == ids(documents)
    by = {r.doc_id: r for r in rows if r.doc_id not in (None, 3)}
    assert by[1].n_removed == 0 and by[2].n_removed == by[2].n_bytes and by[2].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert sorted(r.n_removed for r in rows if r.doc_id == 3) == [0, next(r.n_bytes for r in rows if r.doc_id == 3)]
    assert by[4].n_bytes == by[5].n_bytes == 0 and by[10].n_removed > 0 and by[8].n_spans == 1


def test_quality_and_toxicity(documents, labels):
    for scored in (score_quality(documents, labels), score_toxicity(documents, labels)):
        rows = scored.collect()
        assert Counter(r.doc_id for r in rows) == ids(documents)
        assert all(0 <= r.score <= 1 and r.predicted in (0, 1) and r.held_out is not None for r in rows)
    kept = drop_toxic(documents, labels)
    assert kept.columns == documents.columns and kept.count() <= documents.count()


def test_scores_without_labels(documents, labels):
    none = labels.limit(0)
    assert {r.score for r in score_quality(documents, none).collect()} == {0.5}
    assert {r.score for r in score_toxicity(documents, none).collect()} == {0.0}


def test_near_duplicates(documents):
    rows = near_duplicates(documents).collect()
    assert Counter(r.doc_id for r in rows) == ids(documents)
    classes = {r.doc_id: r.class_id for r in rows if r.doc_id is not None}
    assert classes[1] == classes[2] == 1 and classes[7] == classes[8] == 7 and classes[4] == 4 and classes[5] == 5 and classes[6] == 6
    assert sorted(str(r.class_id) for r in rows if r.doc_id is None) == ["1", "None", "None"]
    kept = keep_first(documents)
    assert kept.columns == documents.columns and Counter(r.doc_id for r in kept.collect())[2] == 0


def test_leaks(spark, documents):
    items = [(1, prose(3)[40:160]), (2, None), (3, ""), (4, "x"), (None, prose(1)), (1, prose(3)[40:160])]
    benchmark = documents.sparkSession.createDataFrame(items, "item_id long, text string")
    found = Counter((r.doc_id, r.item_id) for r in find_leaks(documents, benchmark).collect())
    assert found[3, 1] == 4 and {d for d, _ in found} >= {3}
    kept = drop_leaking(documents, benchmark)
    assert kept.columns == documents.columns and Counter(r.doc_id for r in kept.collect())[3] == 0
    assert find_leaks(documents, benchmark.limit(0)).count() == 0


def test_pieces(documents):
    rows = piece_digest(documents).collect()
    assert Counter(r.doc_id for r in rows) == ids(documents) and all(r.lossless for r in rows)
    assert {r.n_pieces for r in rows if r.doc_id in (4, 5)} == {0}
    back = decode_pieces(encode_documents(documents)).select("doc_id", "decoded").collect()
    want = Counter((r.doc_id, r.text or "") for r in documents.collect())
    assert Counter((r.doc_id, r.decoded) for r in back) == want


def test_secrets(documents):
    digest = secret_digest(find_secrets(documents)).collect()
    assert Counter(r.doc_id for r in digest) == ids(documents)
    masked = mask_secrets(documents)
    assert masked.columns == documents.columns
    assert Counter((r.doc_id, r.text) for r in masked.collect()) == Counter((r.doc_id, r.text) for r in documents.collect())


def test_shards(documents):
    rows = shard_documents(documents).collect()
    assert Counter(r.doc_id for r in rows) == ids(documents)
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 16) for r in rows)


def test_chats(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "<turn x>\\l </turn>"), (1, 1, "assistant", None), (None, None, None, None),
        (2, None, "user", "x"), (2, 0, "robot", ""), (3, 0, "user", "a" * 200_000), (3, 0, "user", "a" * 200_000), (4, 0, "ro<l>e", "\\b<"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("segments", F.lit(1))
    got = {r.conv_id: r for r in chat_digest(format_chats(frame)).collect()}
    for conv in (1, 2, 3, 4, None):
        turns = sorted((t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == conv)
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        learned = "".join(text for _, role, text in turns if role == "assistant")
        assert got[conv].n_turns == len(turns) and got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest() and got[conv].loss_chars == len(learned)
    assert not got[2].valid and got[2].wrong_at == 1
    assert chat_digest(format_chats(frame.limit(0))).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0])]
    rows += [(6, [0.0, 0.0]), (7, [1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (40, [0.0, 0.0]), (9, [-1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("key", F.lit("k"))
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in nearest(frame).orderBy("query_id", "rank").collect()]
    zero = [(r, v, s) for q, r, v, s in got if q == 0]
    assert zero == [(1, 20, 1.0), (2, 20, 1.0), (3, 1, 0.5), (4, 9, -1.0)]
    assert {q for q, *_ in got} == {0, 20}
    assert nearest(frame.limit(0)).count() == 0 and nearest(frame.where("vec_id = 6")).count() == 0


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op6", "op7", "op8", "op9", "op10"])
def test_no_rows(no_documents, labels, name):
    benchmark = labels.select(F.col("doc_id").alias("item_id"), F.lit("some words that are long enough").alias("text"))
    frames = {
        "op1": lambda d: repeat_digest(d), "op2": lambda d: score_quality(d, labels), "op3": lambda d: near_duplicates(d),
        "op6": lambda d: piece_digest(d), "op7": lambda d: secret_digest(find_secrets(d)), "op8": lambda d: shard_documents(d),
        "op9": lambda d: score_toxicity(d, labels), "op10": lambda d: find_leaks(d, benchmark),
    }
    assert frames[name](no_documents).count() == 0


def test_pipeline_over_hard_rows(spark, documents, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, prose(3)[40:160])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    documents.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    found = ids(corpus_pipeline.run(spark, str(tmp_path)))
    assert found[2] == 0 and found[3] == 0 and found[1] == 1 and found[4] == 1

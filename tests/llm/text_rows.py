"""Rows and folders shared by the tests of the text operators."""

import os

from pyspark.sql import functions as F

WORDS = "the quick brown fox jumps over a lazy dog while rain falls on green hills and old stone roads near town".split()


def prose(seed, n=60):
    return " ".join(WORDS[(seed * 7 + i * i + i * seed) % len(WORDS)] + str((seed + i) % 13) for i in range(n))


def hard_documents(spark, empty=False):
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties, and columns with names operators use."""
    long = " ".join(prose(s, 200) for s in range(60))
    rows = [
        (1, prose(1)), (2, prose(1)), (3, prose(3)), (3, prose(3)), (4, None), (5, ""), (6, " \n\t "), (7, long), (8, long),
        (None, prose(9)), (None, None), (10, "é" * 150), (11, "😀 ﬁ ▁x"), (12, "you idiot " + prose(12)), (13, "A!! " * 50),
        (None, prose(1)),
    ]
    kind = "doc_id long, text string"
    frame = spark.createDataFrame([] if empty else rows, kind)
    clashing = ("label", "score", "spans", "shard", "node", "key", "features", "tokens", "copy", "raw", "pieces", "class_id", "lang", "source")
    return frame.withColumns({c: F.lit(None).cast("string") for c in clashing}).withColumn("n_chars", F.lit(1))

SF_ORACLE = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

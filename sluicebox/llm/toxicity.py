"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

The lexicon has two parts: insults in common use, and words and word beginnings that mark toxic documents of the labelled
sample, in whatever language. The sample has about ``SAMPLE_ROWS`` labelled rows at most (a parameter; rows are chosen by a
hash of their id): half of it teaches the lexicon, the other half the trees and their calibration, so that no document is
judged by words it taught. Features are computed once per document in tasks and written to the shared folder, and every
document is scored in tasks by array operations.

Defined results: null and empty texts get the features of an empty text and hence a score; equal texts get equal scores;
a document labelled several times counts once, with the mean of its labels rounded up from one half; null labels are
ignored; without labels of both classes the score is the share of toxic ones (0 without any). Very long texts are read
whole. Other columns are ignored by scoring and kept by ``drop_toxic``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import fold, whole_text, written

SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
ROUNDS, DEPTH, RATE, BINS, LEAST_WEIGHT, RIDGE = 60, 4, 0.2, 64, 2.0, 1.0
NEAR_WORDS, WINDOW_WORDS = 5, 20
BEGINNINGS = range(4, 8)  # lengths of word beginnings that the lexicon may learn
LEAST_DOCUMENTS, LEAST_WEIGHT_OF_TERM = 4, 2.0
REMEMBERED_WORDS = 200_000  # words whose weight a task keeps at hand

# Insults in common use.
LEXICON = frozenset("""
    arrogant bastard brainless clown clowns coward creep cretin crook degenerate despicable disgrace disgusting dimwit dirtbag dumb dumbass
    dunce failure fool freak fraud garbage gross hideous hypocrite idiot idiotic idiots ignorant imbecile incompetent
    jerk lame laughable liar lowlife loser losers lunatic maggot miserable moron moronic morons nasty nobody parasite pathetic
    pig pigs punk repulsive ridiculous rotten rubbish scum scumbag shameful shut sick sleazy slob stupid swine terrible thug trash
    traitor ugly useless vermin vile weakling weirdo worthless wretch
    arschloch blödmann depp dummkopf dumm hässlich idioten trottel versager wertlos widerlich
    abruti connard crétin débile imbécile minable nul ordure salaud stupide
    basura cobarde estúpido idiota imbécil inútil patético perdedor tonto
""".split())
SECOND_PERSON = frozenset("""
    you your yours yourself u ur du dich dir dein deine deiner ihr euch tu te toi ton ta tes vous votre tú ti usted ustedes
""".split())
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i"})

WORD = re.compile(r"[^\W\d_]+")
MIXED = re.compile(r"[^\W\d_]+[0-9@$!|*_.-]+[^\W\d_][\w@$!|*.-]*")
SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][ .*_-]){3,}[^\W\d_](?!\w)")
NOT_LETTER = re.compile(r"[\W\d_]+")

FEATURES = (
    "hits", "hit_share", "hits_near_second_person", "most_in_window", "hidden_hits", "hidden_share", "mixed_share",
    "learned_most", "learned_sum", "learned_words", "learned_share", "capitals", "capital_words", "exclamations", "punctuation", "signs", "second_person", "log_words",
)


class Lexicon:
    """Weights of learned words and word beginnings: log odds of a toxic document against a clean one."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.weights = weights
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        """The largest weight of the word and its beginnings; 0 where none was learned."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBERED_WORDS:
                self.known.clear()
            found = self.known[word] = max((self.weights.get(t, 0.0) for t in terms_of(word)), default=0.0)
        return found


def terms_of(word: str) -> list[str]:
    """The whole word, marked by a blank at its end, and its beginnings."""
    return [word + " ", *(word[:k] for k in BEGINNINGS if len(word) >= k)]


def features_of(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of one text, in the order of ``FEATURES``."""
    low = text.lower()
    words = WORD.findall(low)
    n = max(1, len(words))
    hits = [i for i, w in enumerate(words) if w in LEXICON]
    persons = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    weight = lexicon.weight
    learned = [x for x in map(weight, words) if x] if lexicon.weights else []
    near = most = 0
    if hits:
        at, who = np.array(hits), np.array(persons)
        if persons:
            j = np.searchsorted(who, at)
            left = at - who[np.maximum(j - 1, 0)]
            right = who[np.minimum(j, len(who) - 1)] - at
            near = int(((np.abs(left) <= NEAR_WORDS) | (np.abs(right) <= NEAR_WORDS)).sum())
        most = int((np.searchsorted(at, at + WINDOW_WORDS) - np.arange(len(at))).max())
    mixed = MIXED.findall(low)
    hidden = sum(NOT_LETTER.sub("", w.translate(LEET)) in LEXICON for w in mixed)
    hidden += sum(NOT_LETTER.sub("", w) in LEXICON for w in SPACED.findall(low))
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(raw, minlength=256)
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    marks = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
    signs = int(counts[[35, 36, 37, 38, 42, 64, 94, 126, 124]].sum())
    chars = max(1, len(text))
    return [
        np.log1p(len(hits)), 100 * len(hits) / n, np.log1p(near), float(most), np.log1p(hidden), 100 * hidden / n, 100 * len(mixed) / n,
        max(learned, default=0.0), sum(learned), np.log1p(len(learned)), 100 * len(learned) / n,
        upper / chars, upper / max(1, upper + lower), counts[33] / chars, marks / chars, signs / chars, 100 * len(persons) / n,
        np.log1p(len(words)),
    ]


def text_features(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id and ``features``, one row per document."""
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "features": [features_of(t, lexicon) for t in batch["text"]]})

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", whole_text().alias("text"))
    return rows.mapInPandas(compute, f"doc_id {kind}, features array<double>")


def sampled_labels(labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, label and ``half`` of about ``sample_rows`` labelled documents outside the held-out fold."""
    known = labelled(labels, "toxic", FOLDS, HELD_OUT)
    share, buckets = min(1.0, sample_rows / max(1, known.count())), 1 << 30
    drawn = known.withColumn("draw", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    return drawn.where(F.col("draw") < int(buckets * share)).select("doc_id", "label", (F.col("draw") % 2).alias("half"))


def learn_lexicon(documents: DataFrame, sample: DataFrame) -> Lexicon:
    """Terms that at least ``LEAST_DOCUMENTS`` toxic documents of the first half hold and clean ones rarely do."""
    taught = documents.select("doc_id", whole_text().alias("text")).join(sample.where("half = 0"), "doc_id").select("label", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        rows = [0, 0]
        for batch in batches:
            for label, text in zip(batch["label"], batch["text"], strict=True):
                rows[label] += 1
                counts[label].update({t for w in set(WORD.findall(text.lower())) for t in terms_of(w)})
        terms = [*counts[1], *(t for t in counts[0] if t not in counts[1]), ""]
        yield pd.DataFrame({
            "term": terms,
            "toxic": [*(counts[1][t] for t in terms[:-1]), rows[1]],
            "clean": [*(counts[0][t] for t in terms[:-1]), rows[0]],
        })

    counted = taught.mapInPandas(count, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    held = written(counted.where(F.col("toxic") >= LEAST_DOCUMENTS), "lexicon")
    total = held.where("term = ''").first()
    if total is None:
        return Lexicon({})
    weight = F.ln((F.col("toxic") + 0.5) / (total["toxic"] + 1.0)) - F.ln((F.col("clean") + 0.5) / (total["clean"] + 1.0))
    terms = held.where("term <> ''").select("term", weight.alias("weight")).where(F.col("weight") >= LEAST_WEIGHT_OF_TERM)
    return Lexicon({r["term"]: r["weight"] for r in terms.collect()})  # all that pass, out of the bounded sample


class Trees:
    """Boosted regression trees on the logistic loss, grown level by level over quantile bins; complete trees as arrays."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> None:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        self.base = float(np.log(max(y.mean(), 1e-6) / max(1 - y.mean(), 1e-6)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        binned = self._binned(x)
        margin = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(binned, p - y, p * (1 - p))
            self.trees.append(tree)
            margin += self._value(tree, binned)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T, strict=True)], axis=1)

    def _grow(self, binned: np.ndarray, gradient: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        nodes = 2**DEPTH - 1
        feature, cut, leaf = np.zeros(nodes, int), np.full(nodes, BINS), np.zeros(2**DEPTH)
        at = np.zeros(len(binned), int)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-9)
            for j in range(binned.shape[1]):
                cell = (at - first) * BINS + binned[:, j]
                g = np.bincount(cell, gradient, width * BINS).reshape(width, BINS)
                h = np.bincount(cell, hessian, width * BINS).reshape(width, BINS)
                gl, hl = np.cumsum(g, 1), np.cumsum(h, 1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                gain[(hl < LEAST_WEIGHT) | (ht - hl < LEAST_WEIGHT)] = 0
                k = gain.argmax(1)
                better = gain[np.arange(width), k] > best
                best = np.where(better, gain[np.arange(width), k], best)
                feature[first : first + width][better], cut[first : first + width][better] = j, k[better]
            at = 2 * at + 1 + (binned[np.arange(len(at)), feature[at]] > cut[at])
        slot = at - nodes
        g, h = np.bincount(slot, gradient, 2**DEPTH), np.bincount(slot, hessian, 2**DEPTH)
        return feature, cut, -RATE * g / (h + RIDGE)

    @staticmethod
    def _value(tree: tuple[np.ndarray, np.ndarray, np.ndarray], binned: np.ndarray) -> np.ndarray:
        feature, cut, leaf = tree
        at, rows = np.zeros(len(binned), int), np.arange(len(binned))
        for _ in range(DEPTH):
            at = 2 * at + 1 + (binned[rows, feature[at]] > cut[at])
        return leaf[at - len(feature)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        return self.base + sum(self._value(t, binned) for t in self.trees)


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing fit of labels over margins, by pooling adjacent violators."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, rows, lowest margin, highest margin
    for m, t in zip(margin[order], y[order], strict=True):
        blocks.append([float(t), 1.0, float(m), float(m)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    ends = [m for b in blocks for m in (b[2], b[3])]
    levels = [b[0] / b[1] for b in blocks for _ in range(2)]
    return np.array(ends), np.array(levels)


class ToxicityModel:
    """Trees fitted on three quarters of the sample, calibrated on the rest."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        self.constant = float(y.mean()) if len(y) else 0.0
        self.trees = None
        if len(y) and 0 < y.mean() < 1:
            part = np.arange(len(y)) % 4 == 3
            fit = ~part if len(y) >= 40 and 0 < y[~part].mean() < 1 else np.ones(len(y), bool)
            self.trees = Trees(x[fit], y[fit])
            rest = ~fit if (~fit).any() else fit
            self.ends, self.levels = isotonic(self.trees.margin(x[rest]), y[rest])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None or not len(x):
            return np.full(len(x), self.constant)
        return np.clip(np.interp(self.trees.margin(x), self.ends, self.levels), 0, 1)


def labelled(labels: DataFrame, column: str, folds: int, held_out: int) -> DataFrame:
    """doc_id and ``label`` (0 or 1), once per document outside the held-out fold."""
    rows = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
    return rows.groupBy("doc_id").agg((F.avg(F.col(column)) >= 0.5).cast("int").alias("label"))


def train(features: DataFrame, sample: DataFrame) -> ToxicityModel:
    """Fits on the second half of the sample; equal ids count once."""
    once = features.groupBy("doc_id").agg(F.min("features").alias("features"))
    rows = once.join(sample.where("half = 1"), "doc_id").select("label", "features").orderBy(F.xxhash64("doc_id")).toPandas()
    x = np.array(rows["features"].tolist(), float).reshape(len(rows), len(FEATURES))
    return ToxicityModel(x, rows["label"].to_numpy(float))


def apply_model(features: DataFrame, model: ToxicityModel) -> DataFrame:
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["features"].tolist(), float).reshape(len(batch), len(FEATURES))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": model.score(x)})

    kind = features.schema["doc_id"].dataType.simpleString()
    return features.mapInPandas(compute, f"doc_id {kind}, score double")


def _learned(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, Lexicon, ToxicityModel]:
    sample = written(sampled_labels(labels), "toxicity-sample")
    lexicon = learn_lexicon(documents, sample)
    features = written(text_features(documents, lexicon), "toxicity")
    return features, lexicon, train(features, sample)


def score_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    features, _, model = _learned(documents, labels)
    return apply_model(features, model).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents scored below the threshold, with all their columns; each text is judged by itself, row by row."""
    sample = written(sampled_labels(labels), "toxicity-sample")
    lexicon = learn_lexicon(documents, sample)
    fitted_on = documents.join(sample.where("half = 1").select("doc_id"), "doc_id", "left_semi")
    model = train(written(text_features(fitted_on, lexicon), "toxicity"), sample)

    def keep(texts: pd.Series) -> pd.Series:
        x = np.array([features_of(t, lexicon) for t in texts], float).reshape(len(texts), len(FEATURES))
        return pd.Series(model.score(x) < THRESHOLD)

    return documents.where(F.pandas_udf(keep, "boolean")(whole_text()))

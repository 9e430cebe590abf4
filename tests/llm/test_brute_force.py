"""Each operator against a plain computation of the same result on a small table."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import duckdb
import numpy as np
import pytest
from text_rows import SF_ORACLE
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluicebox.llm import neighbours
from sluicebox.llm import pieces as sp
from sluicebox.llm import suffix_dedup
from sluicebox.llm.decontaminate import Block, _leaks_in, normal
from sluicebox.llm.induced import suffixes_with_prefixes
from sluicebox.llm.near_dup import Powers, probability_jaccard, registers_of, shingles
from sluicebox.llm.queries import LLM_ORACLE, LLM_QUERIES
from sluicebox.llm.secrets import ASSIGN


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


@pytest.mark.parametrize("name", list(LLM_ORACLE))
def test_query_matches_sql(spark, name):
    frame = LLM_QUERIES[name](spark, SF_ORACLE)
    with duckdb.connect() as duck:
        for table in ("documents", "conversations", "embeddings"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_ORACLE}/{table}.parquet'")
        result = duck.execute(LLM_ORACLE[name])
        columns = [d[0] for d in result.description]
        want = sorted(map(repr, result.fetchall()))
    assert sorted(map(repr, (tuple(r) for r in frame.select(*columns).collect()))) == want


def test_texts_with_one_key_are_no_copies(spark, monkeypatch):
    """Copies are told by the whole digest: where packed names collide, different texts keep their bytes and copies go."""
    monkeypatch.setattr(suffix_dedup, "_key", lambda whole: F.lit(7).cast("long"))
    one, two = ("".join(random.Random(n).choices("abcdefgh ", k=400)) for n in (1, 2))
    frame = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in suffix_dedup.repeat_digest(frame).collect()} == {1: 0, 2: 0, 3: 400}


def test_suffix_dedup_of_all_texts(spark, texts):
    got = {r.doc_id: r for r in LLM_QUERIES["op1_suffix_array_dedup"](spark, SF_ORACLE).collect()}
    seen = set()
    for i in sorted(texts):
        raw = texts[i].encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - 99):
            window = raw[at : at + 100]
            if window in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (not at or not gone[at - 1]) for at, g in enumerate(gone))
        assert (got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (sum(gone), spans, hashlib.sha256(kept).hexdigest())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab\0", max_size=40).map(str.encode), min_size=1, max_size=5), st.integers(1, 3))
def test_induced_sorting(parts, times):
    parts = parts + [parts[0] * times]
    found, prefix, starts = suffixes_with_prefixes(parts, 16)
    text = [c + 2 for c in b"\0".join(parts) + b"\0"]
    for a, p in zip(starts, parts, strict=True):
        text[a + len(p)] = 1
    want = sorted(range(len(text)), key=lambda i: text[i:] + [0], reverse=True)
    assert list(found) == want
    for a, b, common in zip(want, want[1:], prefix[1:].tolist()):
        inside = min(text[a:].index(1), text[b:].index(1), 16)
        alike = next((k for k in range(inside) if text[a + k] != text[b + k]), inside)
        assert min(common, inside) == alike


def test_induced_sorting_with_runs_on_disk(monkeypatch, tmp_path):
    from sluicebox.llm import induced

    parts = [bytes(random.Random(i).choices(b"abcd", k=400)) for i in range(10)]
    plain = suffixes_with_prefixes(parts, 100)
    monkeypatch.setattr(induced, "MEMORY_ENTRIES", 50)
    spilled = suffixes_with_prefixes(parts, 100, str(tmp_path))
    assert all((a == b).all() for a, b in zip(plain, spilled, strict=True))


def test_repeats_take_no_more_passes_than_other_texts(monkeypatch):
    """Stretches that repeat are told apart by what follows them, not by passes over texts of their names."""
    from sluicebox.llm import induced

    line, passes = bytes(random.Random(5).choices(b"abcd ", k=700)), []
    parts = [line * 3, line[100:], b"a" * 900, b"ab" * 500, line, b"aab" * 300]
    plain = induced.induce
    monkeypatch.setattr(induced, "induce", lambda *given: (passes.append(len(given[2])), plain(*given))[1])
    found, _, starts = suffixes_with_prefixes(parts, 100)
    text = [c + 2 for c in b"\0".join(parts) + b"\0"]
    for a, p in zip(starts, parts, strict=True):
        text[a + len(p)] = 1
    assert list(found) == sorted(range(len(text)), key=lambda i: text[i:] + [0], reverse=True)
    assert len(passes) == 2


@pytest.mark.parametrize("block", [1, 7, 250])
def test_anchors_do_not_depend_on_blocks(monkeypatch, block):
    rng = random.Random(block)
    parts = [bytes(rng.choices(b"ab" if i % 2 else b"abcdefgh ", k=k)) for i, k in enumerate((0, 300, 99, 100, 101, 0, 800, 5, 450))]
    whole = suffix_dedup.window_anchors(parts, Powers())
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    assert all((a == b).all() for a, b in zip(whole, suffix_dedup.window_anchors(parts, Powers()), strict=True))


def jaccard(a, b):
    if max(a.values()) == max(b.values()) == 1:
        return len(a & b) / len(a | b)
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a | b) for i in a if i in b)


def test_near_duplicates_of_all_texts(spark, texts):
    sets = {}
    for i, text in texts.items():
        words = text.lower().split()
        sets[i] = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4)) or Counter([tuple(words)] if words else [])
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in sets:
        shared = Counter(j for x in sets[i] for j in holders[x] if j < i)
        for j, n in shared.items():
            if 2 * n > max(len(sets[i]), len(sets[j])) and root(i) != root(j) and jaccard(sets[i], sets[j]) >= 0.8:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    got = {r.doc_id: r.class_id for r in LLM_QUERIES["op3_minhash_near_dedup"](spark, SF_ORACLE).collect()}
    assert got == {i: root(i) for i in sets}


def test_registers_estimate_the_weighted_similarity():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    a = " ".join(rng.choices(words, k=400))
    b = a[:1500] + " " + " ".join(rng.choices(words, k=60))
    hits = []
    for salt in range(60):
        text, hashed, count = shingles([a + f" {salt}" * 5, b + f" {salt}" * 5], Powers())
        registers = registers_of(text, hashed, count, 2)
        hits.append((registers[0] == registers[1]).mean())
    text, hashed, count = shingles([a, b], Powers())
    packed = [((hashed[text == i] >> np.uint64(32)).astype(np.uint32).tobytes(), count[text == i].astype(np.uint32).tobytes()) for i in (0, 1)]
    exact = probability_jaccard(*packed)
    left, right = ({h: c for h, c, t in zip(hashed, count, text) if t == i} for i in (0, 1))
    assert exact == pytest.approx(sum(1 / sum(max(left.get(j, 0) / left[i], right.get(j, 0) / right[i]) for j in left | right) for i in left if i in right), abs=1e-6)
    assert np.mean(hits) == pytest.approx(exact, abs=0.04)


def test_neighbours_recall(spark):
    rows = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").collect()
    at = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], float)
    found = defaultdict(list)
    for r in LLM_QUERIES["op4_nearest_neighbours"](spark, SF_ORACLE).orderBy("rank").collect():
        found[r.query_id].append(r.vec_id)
        assert r.score == pytest.approx(float(x[at == r.query_id][0] @ x[at == r.vec_id][0]), abs=1e-12)
    recall = []
    for i in np.flatnonzero(at % 20 == 0):
        scores = x @ x[i]
        scores[i] = -np.inf
        best = at[np.lexsort((at, -scores))[:20]]
        recall.append(len(set(best) & set(found[at[i]])) / 20)
    assert np.mean(recall) >= 0.9


@pytest.mark.parametrize("norms", ["log-normal", "one long", "tiny and huge"])
def test_neighbours_recall_with_uneven_norms(spark, norms):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(4_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms == "log-normal":
        x *= rng.lognormal(size=(len(x), 1))
    elif norms == "one long":
        x[17] *= 1000
    else:
        x *= np.where(np.arange(len(x)) % 3 == 0, 1e-200, 1e100)[:, None]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in neighbours.nearest(frame).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r.vec_id)
    recall = []
    for i in range(0, len(x), 20):
        scores = x @ x[i]
        scores[i] = -np.inf
        assert len(found[i]) == 20
        recall.append(len(set(np.lexsort((np.arange(len(x)), -scores))[:20].tolist()) & set(found[i])) / 20)
    print(norms, np.mean(recall), min(recall))
    assert np.mean(recall) >= 0.9


def test_pieces_without_dropout_are_the_model_s(texts):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=sp.default_model())
    plain = sp.Encoder(sp.Vocabulary.load(sp.default_model()), 0.0)
    for text in [*list(texts.values())[:150], " a  b ", "\n\n", "ﬁ Ａ\t", "<s> <0x0A>", "x" * 300]:
        assert plain.encode(text) == model.encode(text)


@cache
def vocabulary_of_the_model():
    return sp.Vocabulary.load(sp.default_model())


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"])), st.integers(0, 5))
def test_pieces_decode_to_the_text(text, seed):
    vocabulary = vocabulary_of_the_model()
    encoder = sp.Encoder(vocabulary, 0.3, seed)
    numbers = encoder.encode(text, "k")
    assert sp.decode(numbers, vocabulary) == text and numbers == sp.Encoder(vocabulary, 0.3, seed).encode(text, "k")


def test_dropout_varies_by_seed_and_both_agendas_agree(texts):
    vocabulary = sp.Vocabulary.load(sp.default_model())
    some = list(texts.values())[:30]
    one, two = (sp.Encoder(vocabulary, 0.2, seed) for seed in (1, 2))
    assert sum(one.encode(t) != two.encode(t) for t in some) > 25
    for text in some:
        symbols = list(text[:400].replace(" ", sp.MARK))
        short, long = (merge(list(symbols), vocabulary.costs, sp.Draws(one.limits, 9)) for merge in (sp._merge_short, sp._merge_long))
        assert short == long


def plainly_merged(unit, vocabulary, skipped):
    """The agenda read as its definition: all pairs are looked at before every pop, and a skipped pair is left until it changes."""
    parts = [(i, c) for i, c in enumerate(unit.replace(" ", sp.MARK))]
    refused, pop = set(), 0
    while True:
        pairs = [
            (vocabulary.costs[a[1] + b[1]], a[0], n) for n, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
            if a[1] + b[1] in vocabulary.costs and (a, b) not in refused
        ]
        if not pairs:
            return [vocabulary.numbers[t] for _, t in parts], pop
        n = min(pairs)[2]
        if skipped(pop):
            refused.add((parts[n], parts[n + 1]))
        else:
            parts[n : n + 2] = [(parts[n][0], parts[n][1] + parts[n + 1][1])]
        pop += 1


def test_dropout_is_drawn_per_pop_of_each_occurrence():
    """Every occurrence follows its own draws, whatever is remembered; skips are as frequent as the rate says."""
    vocabulary = vocabulary_of_the_model()
    words = ["the", "internationalization", "understanding", "a", "statistically", "x" * 70, "of"]
    rng = random.Random(4)
    encoder = sp.Encoder(vocabulary, 0.2, 3)
    pops = skips = 0
    for document in range(60):
        units = [" " + rng.choice(words) for _ in range(80)]
        seeds, _ = encoder.seeds(str(document), len(units))
        want = []
        for unit, seed in zip(units, seeds.tolist(), strict=True):
            draws = sp.Draws(encoder.limits, seed)

            def skipped(pop, draws=draws):
                hit = pop == draws.next
                if hit:
                    draws.skip()
                return hit

            numbers, popped = plainly_merged(unit, vocabulary, skipped)
            want += numbers
            pops, skips = pops + popped, skips + len(draws.skipped)
        assert encoder.encode("".join(units)[1:], str(document)) == want
    assert abs(skips / pops - 0.2) < 0.01


def base_spans(text):
    spans = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text, re.ASCII) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(spans + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def test_secret_digests(spark, tmp_path):
    rng = random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    secret = ["".join(rng.choices(letters, k=40)) for _ in range(20)]
    rows = [(i, f"é😀 value {s} end") for i, s in enumerate(secret)]
    rows += [
        (100, "PassWord = 'abc' token:abcdef AKIA1234 AKIA" + "Z9" * 9 + " " + "0a" * 12 + " " + "0a" * 11),
        (101, "token: token: abcdef apikey=x api_key=\"abcdefg\" SECRET:____...."), (102, "http://some/path/to/a/long/page_name_without_end"),
        (103, "a" * 60 + " " + "ab" * 40), (104, None),
    ]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in LLM_QUERIES["op7_secret_scans"](spark, str(tmp_path)).collect()}
    names = ("assign", "access", "hex")
    for i, text in rows:
        spans = base_spans(text or "")
        listed = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))
    assert sum("random:9:49" in got[i].spans for i in range(20)) >= 18
    assert got[102].n_random == 0 and got[103].n_random == 0


def test_shards_grow_into_the_new_one_only(spark, texts):
    rows = LLM_QUERIES["op8_sharding"](spark, SF_ORACLE).collect()
    assert {r.doc_id for r in rows} == set(texts) and {r.law for r in rows} == {"key"}
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert r.size == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw) and r.grown_shard in (r.shard, 16)
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(16)) and max(counts.values()) < 2 * len(rows) / 16
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    moved = sum(r.grown_shard != r.shard for r in rows)
    assert 0.5 * len(rows) / 17 < moved < 1.6 * len(rows) / 17


def least_edits(item, text):
    row, best = list(range(len(item) + 1)), (len(item), 0)
    for j, c in enumerate(text, 1):
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i - 1] + (x != c), row[i] + 1, new[-1] + 1))
        row = new
        best = min(best, (row[-1], j))
    return best


def test_leaks_are_all_occurrences_within_the_budget():
    rng = random.Random(1)
    letters = "abcdefgh "
    for _ in range(40):
        item = normal("".join(rng.choices(letters, k=rng.choice([9, 20, 60, 200]))))
        block = Block([(1, item)])
        budget = int(block.budget[0])
        documents = []
        for _ in range(5):
            changed = list(item)
            for _ in range(rng.randint(0, budget + 3)):
                at = rng.randrange(len(changed) + 1)
                changed[at : at + rng.randint(0, 1)] = rng.choice(letters) * rng.randint(0, 1)
            around = ["".join(rng.choices(letters, k=rng.choice([0, 4, 50]))) for _ in range(2)]
            documents.append(around[0] + "".join(changed) + around[1])
        got = {x: (edits, end) for x, _, edits, end in _leaks_in(documents, block)}
        for x, text in enumerate(documents):
            want = least_edits(item, normal(text)) if len(item) >= 8 else None
            if want:
                assert got.get(x) == (want if want[0] <= budget else None)


def least_edits_in_all(item, joined):
    """Fewest edits of the item against the stretches that end at each position, all positions at once."""
    places = np.arange(len(joined) + 1, dtype=np.int32)
    row = np.zeros(len(places), np.int32)
    for c in item:
        best = row + 1
        best[1:] = np.minimum(best[1:], row[:-1] + (joined != c))
        row = np.minimum.accumulate(best - places) + places
    return row


def test_leaks_of_all_texts(spark):
    """Every item against every text of the whole table: no leak is missing, none is false, edits and ends are the least."""
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    items = [(r.item_id, normal(r.text)) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    gap = "\n" * max(len(t) for _, t in items)  # wider than any budget
    plain = [normal(r.text or "") for r in rows]
    joined = np.array([ord(c) for c in "".join(t + gap for t in plain)], np.int32)
    begins = np.cumsum([0, *(len(t) + len(gap) for t in plain)])
    want = set()
    for item, text in items:
        budget = int(Block([(item, text)]).budget[0])
        edits = least_edits_in_all([ord(c) for c in text], joined)
        for x in set((np.searchsorted(begins, np.flatnonzero(edits <= budget), "right") - 1).tolist()):
            own = edits[begins[x] : begins[x] + len(plain[x]) + 1]
            if own.min() <= budget:
                want.add((rows[x].doc_id, item, int(own.min()), int(own.argmin())))
    got = [tuple(r) for r in LLM_QUERIES["op10_decontamination"](spark, folder).select("doc_id", "item_id", "edits", "end").collect()]
    assert want and sorted(got) == sorted(want)


def test_leaks_of_repeated_characters(monkeypatch):
    """Hits are counted in stretches and per band, so one character repeated takes bounded memory; the first end is kept."""
    for item, text, want in (("a" * 300, "a" * 200_000, (0, 300)), ("ab" * 150, "b" + "ab" * 50_000, (0, 301)), ("a" * 299 + "b", "a" * 20_000, (1, 299))):
        assert list(_leaks_in([text, "", text], Block([(1, item)]))) == [(0, 0, *want), (2, 0, *want)]
    whole = []
    for hits, stretch in ((500_000, 1_000_000), (50, 64)):
        monkeypatch.setattr("sluicebox.llm.decontaminate.HITS", hits)
        monkeypatch.setattr("sluicebox.llm.decontaminate.STRETCH", stretch)
        rng = random.Random(7)
        items = [(i, normal("".join(rng.choices("ab ", k=k)))) for i, k in enumerate((12, 40, 90, 40))]
        documents = ["".join(rng.choices("ab ", k=200)) + items[i % 4][1] + "".join(rng.choices("ab ", k=200)) for i in range(20)]
        whole.append(sorted(_leaks_in(documents, Block(items))))
    assert whole[0] and whole[0] == whole[1]


@pytest.mark.parametrize(("name", "label", "least"), [("op2_quality_classifier", "quality", 0.95), ("op9_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, label, least):
    folder = "/root/testdata/sf0.1"
    known = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in LLM_QUERIES[name](spark, folder).collect() if r.held_out and r.doc_id in known]
    assert len(rows) > 500 and np.mean([r.predicted == known[r.doc_id] for r in rows]) >= least


def without_repeats(texts):
    """Removed bytes, spans and what remains of each text, in order of ids."""
    seen, found = set(), {}
    for i in sorted(texts):
        raw = texts[i].encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - 99):
            window = raw[at : at + 100]
            if window in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        found[i] = (sum(gone), sum(g and (not at or not gone[at - 1]) for at, g in enumerate(gone)), hashlib.sha256(kept).hexdigest())
    return found


def test_suffix_dedup_of_hot_anchors_in_many_shards(spark, monkeypatch):
    rng = random.Random(8)
    passage = "".join(rng.choices("abcdefgh ", k=230))
    texts = {}
    for i in range(3 * suffix_dedup.HOT // 2):
        before, after = ("".join(rng.choices("abcdefgh ", k=rng.randrange(60, 180))) for _ in range(2))
        start = rng.randrange(40)
        texts[i] = before + passage[start : start + rng.randrange(120, 230)] + after
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 500)
    rows = suffix_dedup.repeat_digest(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == without_repeats(texts)


def test_anchors_of_a_text_beyond_the_bits_of_a_place():
    part = np.random.default_rng(3).integers(0, 256, 3_000, np.uint8).tobytes()
    far = (1 << suffix_dedup.PLACE_BITS) + 5_000
    text = np.random.default_rng(4).integers(0, 256, far, np.uint8).tobytes() + part
    _, low, high, place, hashed = suffix_dedup.window_anchors([part + b"-" + text], Powers())
    assert (place >= high).all() and (place + suffix_dedup.GRAM <= low + suffix_dedup.WINDOW).all()
    first, second = ({(p - at, h) for a, b, p, h in zip(low, high, place, hashed) if at <= a and b + 100 <= at + 3_000} for at in (0, far + 3_001))
    assert first and len(first ^ second) <= 2  # runs at the ends of the part may reach over them


def test_graph_is_settled(spark):
    codes = np.random.default_rng(2).integers(-40, 41, (6_000, 48)).astype(np.int8)
    packed = neighbours.packed_bytes(codes.astype(float))
    nodes = spark.createDataFrame([(i, c, 0) for i, c in enumerate(packed)], "node long, code binary, span int")
    scores = codes.astype(np.float32) @ codes.T.astype(np.float32)
    np.fill_diagonal(scores, -np.inf)
    least = -np.sort(-scores, axis=1)[:, neighbours.NEIGHBOURS - 1]
    lists = neighbours.build_graph(nodes, {0: len(codes)}, 48).collect()
    hits = [(scores[r.node, np.frombuffer(r.others, np.int64)] >= least[r.node]).sum() / neighbours.NEIGHBOURS for r in lists]
    assert len(hits) == len(codes) and np.mean(hits) > 0.9


def test_walk_goes_on_while_there_are_better_nodes(spark):
    codes = [neighbours.packed_bytes(np.array([[float(i)]]))[0] for i in range(21)]
    chain = [(i, np.array([i + 1], np.int64).tobytes(), codes[i + 1]) for i in range(20)]
    adjacency = spark.createDataFrame(chain, "node long, ids binary, codes binary")
    first = np.array([0], np.int64).tobytes(), np.zeros(1, np.float32).tobytes()
    walkers = spark.createDataFrame([(0, codes[1], *first)], "node long, code binary, others binary, scores binary")
    found = neighbours.walk(walkers, adjacency).collect()
    assert set(np.frombuffer(found[0].others, np.int64)) == set(range(21))


def test_long_units_vary_by_document_and_place():
    encoder = sp.Encoder(vocabulary_of_the_model(), 0.3, 1)
    word = "internationalization"
    kinds = {tuple(encoder.encode(word, f"{i}")) for i in range(200)}
    assert len(kinds) > 2
    assert len({n for i in range(50) if (n := tuple(encoder.encode(f"{word} " * i + word, "k"))[-3:])}) > 1

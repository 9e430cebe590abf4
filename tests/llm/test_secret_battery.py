"""Secret scan against a plain computation: places, battery, error control and masks, on whole tables and on many matches."""

import math
import random
import re
from collections import defaultdict

import pytest
from sf_tables import SF_ORACLE

from sluicebox.llm.secrets import ACCESS, ALPHABETS, ASSIGN, HEX, KINDS, PLAIN, TOKEN, find_secrets, mask_secrets


def upper_tail(z):
    return math.erfc(z / math.sqrt(2)) / 2


def judged(token):
    """Joined p-value, log likelihood ratio and length class, or None for a token without encoding."""
    core = token.rstrip("=")
    alphabet = next((a for pattern, a in ALPHABETS.values() if re.match(pattern, core)), None)
    if alphabet is None:
        return None
    values = [alphabet.index(c) for c in (core.lower() if len(alphabet) == 16 else core)]
    n, size = len(values), len(alphabet)
    chi = sum(values.count(s) ** 2 for s in range(size)) * size / n - n
    free = size - 1
    z_chi = ((max(chi, 0) / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    middle = (size - 1) / 2
    pairs = list(zip(values, values[1:]))
    z_runs = (sum((a > middle) != (b > middle) for a, b in pairs) - (n - 1) / 2) / math.sqrt((n - 1) / 4)
    z_serial = sum((a - middle) * (b - middle) for a, b in pairs) / ((size * size - 1) / 12) / math.sqrt(n - 1)
    tails = upper_tail(z_chi), 2 * upper_tail(abs(z_runs)), 2 * upper_tail(abs(z_serial))
    half = -sum(math.log(max(p, 1e-300)) for p in tails)
    plain = sum(len(re.findall(pattern, core)) * math.log(share / kinds) for pattern, share, kinds in PLAIN.values())
    return math.exp(-half) * (1 + half + half * half / 2), -n * math.log(size) - plain, min(int(math.log2(n)), 31)


def plain_spans(texts):
    base, tests = [], []
    for text in texts:
        text = text or ""
        found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer(ACCESS, text)]
        found += [(m.start(), 2, m.end()) for m in re.finditer(HEX, text)]
        free = [m for m in re.finditer(TOKEN, text) if not any(s < m.end() and m.start() < e for s, _, e in found)]
        base.append(found)
        tests.append([((m.start(), 3, m.end()), judged(m[0])) for m in free])
    by_class = defaultdict(list)
    for row in tests:
        for _, result in row:
            if result:
                by_class[result[2]].append(result)
    least = {}
    for length, results in by_class.items():
        for step in range(240, -1, -1):
            passed = sum(p >= 1e-3 and min(evidence, 60.0) >= step / 4 for p, evidence, _ in results)
            if passed and math.exp(-step / 4) <= 0.01 * passed / len(results):
                least[length] = step / 4
    return [
        sorted(found + [span for span, r in row if r and r[0] >= 1e-3 and r[1] >= least.get(r[2], math.inf)])
        for found, row in zip(base, tests)
    ]


def plain_mask(text, spans):
    done, parts = 0, []
    for start, kind, end in spans:
        if start >= done:
            parts.append(text[done:start] + f"[{KINDS[kind]}]")
        done = max(done, end)
    return "".join(parts) + text[done:]


def check(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = dict(zip([i for i, _ in rows], plain_spans([t for _, t in rows])))
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans] for r in find_secrets(frame).collect()}
    assert got == want
    masked = {r.doc_id: r.text for r in mask_secrets(frame).collect()}
    assert masked == {i: plain_mask(t, want[i]) if want[i] else t for i, t in rows}
    return want


def test_whole_documents_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text").collect()]
    draw = random.Random(5)  # the table has assignments and hexadecimal runs; keys and random tokens are put beside its rows
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rows += [(-1 - i, f"key AKIA{'Q7' * (i % 9 + 4)} and {''.join(draw.choices(signs, k=20 + i))}== end") for i in range(40)]
    want = check(spark, rows)
    assert {kind for spans in want.values() for _, kind, _ in spans} == {0, 1, 2, 3}


@pytest.mark.parametrize("joint", [" ", "", "-", "é\n"])
def test_matches_beside_and_across_each_other(spark, joint):
    draw = random.Random(len(joint))

    def word():
        kind = draw.choice(["hex", "access", "assign", "token", "word"])
        if kind == "hex":
            return "".join(draw.choices("0123456789abcdef", k=draw.randint(20, 40)))
        if kind == "access":
            return "AKIA" + "".join(draw.choices("ABCXYZ0189", k=draw.randint(12, 22)))
        if kind == "assign":
            return draw.choice(["password=", 'Token": "', "api_key: "]) + "".join(draw.choices("abXY01+/_.=-", k=draw.randint(2, 30)))
        if kind == "token":
            return "".join(draw.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=draw.randint(15, 60)))
        return draw.choice(["déjà", "a", "日本", "\U0001f600"])

    check(spark, [(i, joint.join(word() for _ in range(i))) for i in range(0, 60, 3)] + [(1000, None), (1001, "")])


def test_very_many_matches_in_one_text(spark):
    draw = random.Random(9)
    words = ["".join(draw.choices("0123456789abcdef", k=30)) if i % 2 else "é" * 3 for i in range(60_000)]
    frame = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    spans = find_secrets(frame).first().spans
    assert len(spans) == 30_000 and [s.start for s in spans[:2]] == [4, 39] and spans[-1].end == len(" ".join(words))
    assert mask_secrets(frame).first().text == " ".join("[hex]" if i % 2 else "é" * 3 for i in range(60_000))

"""Flat events: truth table, file tree and outputs."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluicebox.catalog.fixtures import flat_texts
from sluicebox.catalog.stored import TREE_SUFFIX, flat_tree
from sluicebox.operators.flat import accepted, add_issues, counts_per_folder, one_row_per_issue, parse_flat, typed
from sluicebox.plans.flat import run_flat
from sluicebox.sources import flat_files
from sluicebox.sources.flat_files import UnreadableFiles, empty_flat_files, flat_folders, scan_flat_files
from sluicebox.streaming import flat as streaming_flat
from sluicebox.streaming.flat import start_flat
from sluicebox.sources.layers import read_flat_garbage, read_flat_silver

BASE = {"transaction_id": "t", "amount": 1, "timestamp": "2026-01-01T00:00:00", "bank_id": "B", "channel": "ATM"}
AMOUNT, TIME = ["invalid_amount"], ["invalid_timestamp"]
ALL_MISSING = [f"missing_{name}" for name in BASE]

CASES = {
    "ok": ({}, []),
    "okfloat": ({"amount": 1.5}, []),
    "bool": ({"amount": True}, []),
    "zero": ({"amount": -0.0}, []),
    "str": ({"amount": "1"}, AMOUNT),
    "neg": ({"amount": -1}, AMOUNT),
    "arr": ({"amount": [1]}, AMOUNT),
    "obj": ({"amount": {"a": 1}}, AMOUNT),
    "huge": ({"amount": 10**60}, []),
    "nan": ({"amount": float("nan")}, []),
    "neginf": ({"amount": float("-inf")}, AMOUNT),
    "nullamt": ({"amount": None}, ["missing_amount"] + AMOUNT),
    "nullts": ({"timestamp": None}, ["missing_timestamp"] + TIME),
    "numts": ({"timestamp": 5}, TIME),
    "badts": ({"timestamp": "x"}, TIME),
    "short": ({"timestamp": "2026-1-1"}, TIME),
    "timeonly": ({"timestamp": "10:00"}, TIME),
    "feb31": ({"timestamp": "2026-02-31"}, TIME),
    "z": ({"timestamp": "2026-01-01T10:00:00Z"}, []),
    "basic": ({"timestamp": "20260101T100000"}, []),
    "week": ({"timestamp": "2026-W01-1"}, []),
    "number id": ({"transaction_id": 7}, []),
    "quote": ({"transaction_id": 'a"b\n', "channel": "é"}, []),
}
WHOLE = {
    "negnull": (
        '{"amount": -1, "timestamp": "x"}',
        ["missing_transaction_id", "missing_bank_id", "missing_channel"] + AMOUNT + TIME,
    ),
    "raw": (
        '{"bank_id": "B", "channel": "ATM", "raw_payload": {"amount": 1, "timestamp": "x"}}',
        ["missing_transaction_id", "missing_amount", "missing_timestamp"],
    ),
    "empty object": ("{}", ALL_MISSING),
    "list": ('[{"amount": 1}]', ALL_MISSING),
    "last key wins": (json.dumps(BASE)[:-1] + ', "amount": -2}', AMOUNT),
    "pretty": (json.dumps(BASE, indent=2), []),
    "not json": ("{not json", ["invalid_json"]),
    "single quotes": (str(BASE), ["invalid_json"]),
    "empty": ("", ["invalid_json"]),
    "number": ("5", ["invalid_json"]),
    "null": ("null", ["invalid_json"]),
    "text behind": (json.dumps(BASE) + " junk", ["invalid_json"]),
    "two documents": (json.dumps(BASE) * 2, ["invalid_json"]),
    "list of two": (json.dumps(BASE) + ", " + json.dumps(BASE), ["invalid_json"]),
    "bracket behind": (json.dumps(BASE) + "] x", ["invalid_json"]),
    "brace behind": (json.dumps(BASE) + "} x", ["invalid_json"]),
    "comma behind": (json.dumps(BASE) + ",", ["invalid_json"]),
    "text behind a list": ("[1] x", ["invalid_json"]),
    "blank behind": (json.dumps(BASE) + " \n", []),
    "inner keys twice": (json.dumps(BASE)[:-1] + ', "note": {"a": 1, "a": 2}}', []),
}
TEXTS = {name: (json.dumps(BASE | change), issues) for name, (change, issues) in CASES.items()} | WHOLE


@pytest.fixture(scope="module")
def found(spark):
    rows = spark.createDataFrame([(n, t) for n, (t, _) in TEXTS.items()], "name string, event_text string")
    return {r.name: r.issues for r in add_issues(parse_flat(rows)).select("name", "issues").collect()}


@pytest.mark.parametrize("name", TEXTS)
def test_issues(found, name):
    assert found[name] == TEXTS[name][1]


@pytest.fixture
def tree(tmp_path):
    folder = tmp_path / "bronze" / "bank a+b" / "atm"
    folder.mkdir(parents=True)
    for name, (text, _) in TEXTS.items():
        (folder / f"{name.replace(' ', '_')}.json").write_text(text)
    (folder / "skip.txt").write_text("not an event")
    (folder.parent / "stray.json").write_text("{}")
    (tmp_path / "bronze" / "top.json").write_text("{}")
    deep = folder / "deeper"
    deep.mkdir()
    (deep / "x.json").write_text("{}")
    other = tmp_path / "bronze" / "bank_c" / "pos"
    other.mkdir(parents=True)
    (other / "one.json").write_text(json.dumps(BASE))
    return tmp_path / "bronze"


def test_tree_scan(spark, tree):
    rows = scan_flat_files(spark, str(tree)).collect()
    names = {(r.bank_dir, r.channel_dir, r.file_name) for r in rows}
    expected = {("bank a+b", "atm", f"{n.replace(' ', '_')}.json") for n in TEXTS} | {("bank_c", "pos", "one.json")}
    assert names == expected and len(rows) == len(expected)
    texts = {r.file_name: r.event_text for r in rows}
    assert texts["pretty.json"] == TEXTS["pretty"][0]


def test_root_has_to_be_absolute(spark):
    with pytest.raises(ValueError):
        scan_flat_files(spark, "relative/tree")


@pytest.mark.parametrize("hold", ["table", "persist", "none"])
def test_job_writes_each_side_and_can_run_again(spark, tree, tmp_path, hold):
    silver, garbage = str(tmp_path / "silver"), str(tmp_path / "garbage")
    expected_copies = sum(len(issues) for _, issues in TEXTS.values())
    expected_clean = sum(not issues for _, issues in TEXTS.values()) + 1
    for _ in range(2):
        run_flat(spark, str(tree), silver, garbage, hold)
        copies = read_flat_garbage(spark, garbage)
        assert copies.count() == expected_copies
        assert read_flat_silver(spark, silver).count() == expected_clean
    one = copies.filter("file_name = 'negnull.json'").select("issue", "event_text").collect()
    assert sorted(r.issue for r in one) == sorted(TEXTS["negnull"][1])
    assert {r.event_text for r in one} == {TEXTS["negnull"][0]}
    lines = [json.loads(l) for p in Path(silver).glob("run=*/bank_dir=bank_c/channel_dir=pos/*.json") for l in p.open()]
    assert lines == [{"file_name": "one.json", "event": BASE}] * 2


def test_a_run_keeps_the_events_of_other_files_and_replaces_its_own(spark, tree, tmp_path):
    silver, garbage = str(tmp_path / "silver"), str(tmp_path / "garbage")
    one = tree / "bank_c" / "pos" / "one.json"
    run_flat(spark, str(tree), silver, garbage)
    one.rename(tmp_path / "away.json")
    (tree / "bank_c" / "pos" / "two.json").write_text(json.dumps(BASE | {"transaction_id": "second"}))
    (tree / "bank a+b" / "atm" / "ok.json").write_text(json.dumps(BASE | {"transaction_id": "new"}))
    run_flat(spark, str(tree), silver, garbage)
    rows = read_flat_silver(spark, silver).collect()
    found = {(r.bank_dir, r.file_name): r.transaction_id for r in rows}
    assert len(rows) == len(found)
    assert found["bank_c", "one.json"] == "t" and found["bank_c", "two.json"] == "second" and found["bank a+b", "ok.json"] == "new"


def test_hidden_event_files_are_named_and_empty_folders_counted(spark, tree):
    (tree / "bank_d" / "web").mkdir(parents=True)
    counts = {(r.bank_dir, r.channel_dir): r.n for r in counts_per_folder(scan_flat_files(spark, str(tree)), flat_folders(spark, str(tree))).collect()}
    assert counts == {("bank a+b", "atm"): len(TEXTS), ("bank_c", "pos"): 1, ("bank_d", "web"): 0}
    (tree / "bank_c" / "pos" / "_hidden.json").write_text("{}")
    with pytest.raises(UnreadableFiles, match="bank_c/pos/_hidden.json"):
        scan_flat_files(spark, str(tree))


def test_canonical_keeps_json_types_and_drops_other_fields(spark):
    text = json.dumps(BASE | {"amount": True, "note": "x"})
    rows = spark.createDataFrame([(text,)], "event_text string")
    checked = add_issues(parse_flat(rows))
    kept = accepted(checked)
    assert kept.columns == list(BASE)
    assert json.loads(kept.toJSON().first()) == BASE | {"amount": True}
    assert typed(kept).first().amount == 1.0
    assert one_row_per_issue(checked).count() == 0


def test_empty_files_are_rows_without_text(spark, tree):
    (tree / "bank_c" / "pos" / "none.json").touch()
    (tree / "bank a+b" / "atm" / "a b%.json").touch()
    empty = {(r.bank_dir, r.file_name) for r in empty_flat_files(spark, str(tree)).collect()}
    assert {("bank_c", "none.json"), ("bank a+b", "a b%.json")} <= empty
    texts = {(r.bank_dir, r.file_name): r.event_text for r in scan_flat_files(spark, str(tree)).collect()}
    assert texts["bank_c", "none.json"] == texts["bank a+b", "a b%.json"] == ""
    assert {key for key, text in texts.items() if text == ""} == empty


def test_stream_reads_each_file_once_and_archives_it(spark, tree, tmp_path):
    silver, garbage, archive = (str(tmp_path / n) for n in ("silver", "garbage", "archive"))
    (tree / "bank_c" / "pos" / "none.json").touch()
    rows = {(r.bank_dir, r.file_name) for r in scan_flat_files(spark, str(tree)).filter("event_text <> ''").collect()}

    def run():
        start_flat(spark, str(tree), silver, garbage, str(tmp_path / "checkpoint"), archive, files_per_trigger=5).awaitTermination()
        side = read_flat_silver(spark, silver).select("bank_dir", "file_name").collect()
        other = read_flat_garbage(spark, garbage).select("bank_dir", "file_name").distinct().collect()
        return [tuple(r) for r in side + other]

    first = run()
    assert sorted(first) == sorted(rows)
    assert sorted(run()) == sorted(rows)  # nothing new, nothing twice
    (tree / "bank_c" / "pos" / "late.json").write_text(json.dumps(BASE | {"transaction_id": "late"}))
    assert sorted(run()) == sorted([*rows, ("bank_c", "late.json")])
    moved = {p.name for p in Path(archive).rglob("*.json")}
    assert moved >= {name for _, name in rows} - {p.name for p in tree.rglob("*.json")} and len(moved) > 5
    runs = list(Path(silver).glob("run=*"))
    assert len(runs) == len({p.name for p in runs}) >= 2


def test_files_opened_by_tasks_are_those_of_sparks_reader(spark, tree, monkeypatch):
    folder = tree / "bank a+b" / "atm"
    (folder / "bytes.json").write_bytes(b"\xff\xfe{}\r\n\0")
    (folder / "a b%+.json").write_text("{}\n")
    (folder / "none.json").touch()
    (folder / "_none.json").touch()
    for hidden in ("_web", ".pos"):
        (tree / "bank_c" / hidden).mkdir()
        (tree / "bank_c" / hidden / "x.json").write_text("{}")

    def rows():
        scan = scan_flat_files(spark, str(tree))
        plan = scan._jdf.queryExecution().executedPlan().toString()
        shown = scan.select("bank_dir", "channel_dir", "file_name", F.hex(F.col("event_text").cast("binary")))
        return plan, sorted(shown.collect()), sorted(empty_flat_files(spark, str(tree)).collect())

    by_tasks = rows()
    monkeypatch.setattr(flat_files, "tasks_open", lambda spark, root: None)
    by_reader = rows()
    assert by_tasks[1:] == by_reader[1:] and len(by_tasks[1]) == len(TEXTS) + 7
    assert "FileScan" in by_reader[0] and "FileScan" not in by_tasks[0]


def test_tree_has_one_file_for_each_row_and_no_other(spark, tmp_path):
    events = spark.createDataFrame(
        [(i // 2, datetime(2024, 1, 1), i % 5, "click", float(i)) for i in range(40)] + [(7, datetime(2024, 1, 1), 1, "view", 2.5)] * 3,
        "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE",
    )
    root = Path(flat_tree(spark, events))
    files = [p for p in root.rglob("*") if p.is_file()]
    written = sorted((p.parent.parent.name, p.parent.name, p.read_text()) for p in files)
    assert written == sorted((r.bank_dir, r.channel_dir, r.event_text + "\n") for r in flat_texts(events).collect())
    assert len(files) == 43 and {p.suffix for p in files} == {TREE_SUFFIX}


def test_stream_hands_on_the_texts_of_sparks_reader(spark, tree, tmp_path, monkeypatch):
    folder = tree / "bank a+b" / "atm"
    for name in ("a b%+.json", "ä#?.json"):
        (folder / name).write_text(json.dumps(BASE) + "\r\n")
    (folder / "bytes.json").write_bytes(b"\xff\xfe{}\0")
    (folder / "none.json").touch()

    def run(name):
        out = [str(tmp_path / f"{name}-{n}") for n in ("silver", "garbage", "checkpoint")]
        start_flat(spark, str(tree), *out).awaitTermination()
        silver = read_flat_silver(spark, out[0]).select("bank_dir", "channel_dir", "file_name", "transaction_id")
        garbage = read_flat_garbage(spark, out[1]).select("bank_dir", "channel_dir", "file_name", "issue", "event_text")
        return sorted(map(str, silver.collect())), sorted(map(str, garbage.collect()))

    by_tasks = run("tasks")
    monkeypatch.setattr(flat_files, "tasks_open", lambda spark, root: None)
    assert by_tasks == run("reader") and len(by_tasks[0]) > 2


def test_stream_deals_small_files_to_few_tasks(spark, tmp_path, monkeypatch):
    folder = tmp_path / "bronze" / "bank_c" / "pos"
    folder.mkdir(parents=True)
    for n in range(600):
        (folder / f"{n}.json").write_text(json.dumps(BASE | {"transaction_id": str(n)}))
    tasks, plain = [], streaming_flat.write_both
    monkeypatch.setattr(streaming_flat, "write_both", lambda batch, *a, **k: (tasks.append(batch.rdd.getNumPartitions()), plain(batch, *a, **k)))
    silver, garbage = str(tmp_path / "silver"), str(tmp_path / "garbage")
    start_flat(spark, str(tmp_path / "bronze"), silver, garbage, str(tmp_path / "checkpoint")).awaitTermination()
    assert {r.transaction_id for r in read_flat_silver(spark, silver).collect()} == {str(n) for n in range(600)}
    assert len(tasks) == 1 and tasks[0] <= spark.sparkContext.defaultParallelism
    assert spark.conf.get("spark.sql.files.openCostInBytes", None) is None  # the caller's session is as it was

"""Large JSON files read in ranges: every cut gives what the whole file gives."""

import json
import os

import pytest

from marketweave.sources import json_split as JS

RECORDS = [{"a": 1, "s": 'quote " and \\ and \\" }], ['}, {"a": 2, "s": "x" * 300}, {"a": None, "s": "é日\n\t\\"},
           {"a": 3, "s": "\\\\\\"}, {"a": 4, "s": "", "n": {"b": [1, {"c": "]"}]}}, {}, {"a": 5, "s": "[{"}]


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return f"file://{path}"


@pytest.mark.parametrize("block", [1, 2, 3, 7, 50, 10_000])
@pytest.mark.parametrize("indent", [None, 2])
def test_every_cut_finds_the_records(tmp_path, block, indent):
    """The states of all ranges, carried from one to the next, and the records of each."""
    import pyarrow as pa

    uri = put(tmp_path, "a.json", json.dumps(RECORDS, ensure_ascii=False, indent=indent))
    size = os.path.getsize(tmp_path / "a.json")
    got, quotes, depth, root = [], 0, 0, None
    for a in range(0, size, block):
        r = {"file": uri, "begin": a, "end": min(size, a + block)}
        s = next(JS._sum_up([pa.RecordBatch.from_pylist([r])])).to_pylist()[0]
        root = s["root"] or root
        got += JS._records(r | {"root": root, "inside": quotes, "depth": depth})
        depth += s["in_step"] if quotes else s["out_step"]
        quotes = (quotes + s["quotes"]) % 2
    assert (quotes, depth) == (0, 0)
    assert [json.loads(t) for _, t, _ in got] == RECORDS and all(w for *_, w in got)


def read(spark, folder, **how):
    df = JS.scan_json_splits(spark, str(folder), "a bigint, s string", keep_corrupt=True, block_bytes=16, **how)
    return sorted(((r.a, r.s, r._corrupt) for r in df.collect()), key=repr)


def test_damaged_files_cost_their_own_records(spark, tmp_path):
    put(tmp_path, "cut.json", '[{"a": 1, "s": "x"}, {"a": 2, "s": "y"}, {"a": 3, "s": "z')
    put(tmp_path, "bad.json", '[{"a": 4}, oops, {"a": 5}, , {"a": "no number", "s": 7}]')
    put(tmp_path, "tail.json", '[{"a": 6}] tail')
    put(tmp_path, "open.json", '[{"a": 7}')
    put(tmp_path, "one.json", ' {"a": 8, "s": "an object"}')
    put(tmp_path, "none.json", "[ ]")
    put(tmp_path, "empty.json", "")
    rows = read(spark, tmp_path)
    assert sorted(r[0] for r in rows if r[2] is None and r[0] is not None) == [1, 2, 4, 5, 6, 7, 8]
    assert [r for r in rows if r[2] is None and r[0] is None] == [(None, "7", None)]
    assert sorted(r[2].strip() for r in rows if r[2] is not None) == ["", "", "oops", '{"a": 3, "s": "z']
    strict = read(spark, tmp_path, partial=False)
    assert [r[0] for r in strict if r[2] is None] == [8]
    assert JS.scan_json_splits(spark, str(tmp_path / "missing"), "a bigint").count() == 0


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = [{"a": i, "s": f'{i} "]{{' * (i % 5)} for i in range(5000)]
    put(tmp_path, "big.json", json.dumps(rows))
    df = JS.scan_json_splits(spark, str(tmp_path), "a bigint, s string", block_bytes=8192)
    assert sorted((r.a, r.s) for r in df.collect()) == sorted((r["a"], r["s"]) for r in rows)
    split = JS.split_records(spark, str(tmp_path), 8192)
    per_task = split.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) > 3 and max(r["count"] for r in per_task) < 4000


def test_a_record_beyond_the_bound_is_damaged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(JS, "MAX_RECORD", 100)
    monkeypatch.setattr(JS, "BLOCK_BYTES", 64)
    uri = put(tmp_path, "a.json", json.dumps([{"a": 1}, {"s": "x" * 500}, {"a": 2}]))
    size = os.path.getsize(tmp_path / "a.json")
    got = list(JS._records({"file": uri, "begin": 0, "end": size, "root": "[", "inside": 0, "depth": 0}))
    assert [t is None for _, t, _ in got] == [False, True, False]


def test_a_range_reads_little_beyond_its_end(tmp_path, monkeypatch):
    """The record that is open at the end of a range is read on in small steps."""
    uri = put(tmp_path, "a.json", json.dumps([{"a": i, "s": "x" * 50} for i in range(20_000)]))
    n, real = [], JS._File.read
    monkeypatch.setattr(JS._File, "read", lambda self, a, b: n.append(len(out := real(self, a, b))) or out)
    r = {"file": uri, "begin": 0, "end": 32_768, "root": "[", "inside": 0, "depth": 0}
    assert len(list(JS._records(r))) > 400 and sum(n) < 2 * 32_768


def test_a_record_of_many_steps_is_whole(tmp_path, monkeypatch):
    monkeypatch.setattr(JS, "BEYOND_BYTES", 3)
    monkeypatch.setattr(JS, "BLOCK_BYTES", 64)
    records = [{"a": 1}, {"s": '\\" ] } ' * 100}, {"a": 2}]
    uri = put(tmp_path, "a.json", json.dumps(records))
    got = list(JS._records({"file": uri, "begin": 0, "end": 12, "root": "[", "inside": 0, "depth": 0}))
    assert [json.loads(t) for _, t, _ in got] == records[:2] and all(w for *_, w in got)

"""Line numbers over splits against plain numbering, and the ledger of a stream's batches."""

import json

import pytest

from quillwork.sources import io
from quillwork.sources.versions import BatchLedger, ledger_sink


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "2000b", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_numbers_over_splits(spark, small_splits, tmp_path):
    texts = {
        "a.jsonl": "\n".join(json.dumps({"id": i, "v": "é" * (i % 90)}) if i % 7 else ["", "  ", "{broken", "\r"][i % 4] for i in range(400)),
        "b/c.jsonl": "\n\n" + json.dumps({"id": 1, "v": "x" * 2000}) + "\n" + json.dumps({"id": 2, "v": "end"}) + "\n",
        "empty.jsonl": "", "one.jsonl": json.dumps({"id": 9, "v": None})}
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    got = {(r.path.rsplit(f"{tmp_path}/", 1)[1], r.line_no): (r.id, r.v) for r in io.json_lines(spark, f"file://{tmp_path}", "id long, v string").collect()}
    want = {}
    for name, text in texts.items():
        for i, line in enumerate(text.split("\n")):
            if line.strip() and not line.startswith("{broken"):
                x = json.loads(line)
                want[name, i] = (x["id"], x["v"])
    assert got == want
    assert io.numbered_lines(spark, f"file://{tmp_path}/a.jsonl").rdd.getNumPartitions() > 1
    last = {r.id: r.v for r in io.keyed_lines(spark, f"file://{tmp_path}/b", "id long, v string", "id").collect()}
    assert last == {1: "x" * 2000, 2: "end"}
    assert io.json_lines(spark, f"file://{tmp_path}/none", "id long").collect() == []


def test_ledger(spark, tmp_path):
    root = f"file://{tmp_path}/ledger"
    rows = lambda *x: spark.createDataFrame(x, "k string, sha string, n int")
    ledger = BatchLedger(spark, root)
    assert ledger.rows() is None and ledger.rows(rows(("a", "1", 1)).schema).count() == 0
    sink = ledger_sink(root, ["k", "sha"])
    sink(rows(("a", "1", 1), (None, "1", 2), ("a", "1", 1)), 0)
    sink(rows(("z", "9", 9)), 0)  # the same number again changes nothing
    sink(rows(("a", "1", 7), ("a", "2", 3), (None, "1", 4), (None, None, 5)), 1)
    want = [("a", "1", 1), ("a", "2", 3), (None, "1", 2), (None, None, 5)]
    found = lambda: sorted((tuple(r) for r in ledger.rows().collect()), key=str)
    assert found() == sorted(want, key=str)

    def broken(batch):
        return batch.selectExpr("k", "sha", "if(n > 0, raise_error('no'), n) AS n")

    with pytest.raises(Exception, match="no"):
        ledger_sink(root, ["k", "sha"], broken)(rows(("b", "1", 1)), 2)
    (tmp_path / "ledger" / "log" / f"{2:010d}").write_text('{"batch_id": ')  # the writer died within its entry
    assert found() == sorted(want, key=str)
    sink(rows(("b", "1", 1)), 2)
    sink(rows(), 3)
    assert found() == sorted([*want, ("b", "1", 1)], key=str)

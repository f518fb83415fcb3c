"""Versioned result table and key ledger."""

import pytest
from pyspark.sql import functions as F

from quire.operators import results as R
from quire.operators.key_ledger import KeyLedger
from quire.operators.versioned import VersionedTable, WriteConflict

ROWS = "contract_number string, first_pass_munchable string, first_pass_reason string, second_pass_munchable string, " \
       "second_pass_reason string, n long"


def _rows(spark, n=60):
    rows = [(f"K{i % 40}", "true", f"r{i}", "", "", i) for i in range(n)]
    rows += [("Not found", "true", "s", "", "", 900 + i) for i in range(20)] + [(None, "false", "nan", None, None, 999)]
    return spark.createDataFrame(rows, ROWS)


def _updates(spark, keys):
    rows = [(k, "true", "u1", "false", f"new {k} {i}", i) for k in keys for i in range(2)]
    return spark.createDataFrame(rows, ROWS.replace("n long", "useq long"))


def _content(df):
    return sorted(map(str, df.collect()))


def test_upsert_rewrites_changed_buckets_only(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    rows = _rows(spark)
    assert table.create(rows, buckets=8) == 1
    before = {r.file: r.bucket for r in table.files().collect()}
    updates = _updates(spark, ["K1", "K41", "Not found", "missing"])
    assert table.upsert(updates) == 2
    after = {r.file: r.bucket for r in table.files().collect()}
    gone = {before[f] for f in before.keys() - after.keys()}
    assert len(gone) == 1 and {after[f] for f in after.keys() - before.keys()} == gone
    changed = _content(table.read().where("contract_number = 'K1'"))
    assert changed == _content(R.upsert_results(rows, updates).where("contract_number = 'K1'")) and len(changed) == 2
    assert table.read().count() == rows.count()
    assert _content(table.read(1)) == _content(rows)  # the version before is still there
    assert _content(table.read().where("contract_number = 'Not found'")) == _content(rows.where("contract_number = 'Not found'"))


def test_update_without_a_known_key_writes_nothing(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.create(_rows(spark), buckets=8)
    assert table.upsert(_updates(spark, ["missing", "Error"])) == 1
    assert table.upsert(_updates(spark, [])) == 1 and table.versions() == [1]


def test_failed_write_leaves_the_old_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    rows = _rows(spark)
    table.create(rows, buckets=4)
    broken = _updates(spark, ["K1"]).withColumn("second_pass_reason", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        table.upsert(broken)
    assert table.versions() == [1] and _content(table.read()) == _content(rows)
    assert table.upsert(_updates(spark, ["K1"])) == 2


def test_second_writer_of_a_version_fails(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.create(_rows(spark), buckets=4)
    assert table.upsert(_updates(spark, ["K1"]), base=1) == 2
    won = _content(table.read())
    with pytest.raises(WriteConflict):
        table.upsert(_updates(spark, ["K2"]), base=1)
    assert table.versions() == [1, 2] and _content(table.read()) == won


def test_empty_table_and_missing_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    table.create(_rows(spark).limit(0))
    assert table.read().count() == 0 and table.upsert(_updates(spark, ["K1"])) == 1


def _keys(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "path string")


def test_ledger_reads_what_may_hold_a_key(spark, tmp_path):
    ledger = KeyLedger(spark, str(tmp_path / "l"), buckets=8)
    batches = [[f"p{b}-{i}" for i in range(300)] for b in range(4)]
    for b, keys in enumerate(batches):
        ledger.add(_keys(spark, keys + keys[:5]), b)
    everything = [k for keys in batches for k in keys]
    assert len(ledger.places(_keys(spark, everything))) == 32
    asked = [*everything[::7], *[f"new{i}" for i in range(200)], None, None]
    known = {r.path for r in ledger.known(_keys(spark, asked)).collect()}
    assert known == set(everything[::7])  # no key of the ledger is missed, none is made up
    left = [r.path for r in ledger.unprocessed(_keys(spark, [*asked, "new0"])).collect()]
    assert sorted(map(str, left)) == sorted(map(str, [*[f"new{i}" for i in range(200)], "new0", None, None]))
    # a small batch reads few folders, and a batch of new keys next to none
    one = ledger.places(_keys(spark, ["p2-17"]))
    assert (2, [x for b, x in one if b == 2][0]) in one and len(one) <= 2
    assert len(ledger.places(_keys(spark, [f"other{i}" for i in range(20)]))) <= 4


def test_ledger_scan_is_pruned(spark, tmp_path):
    ledger = KeyLedger(spark, str(tmp_path / "l"), buckets=4)
    for b in range(3):
        ledger.add(_keys(spark, [f"p{b}-{i}" for i in range(50)]), b)
    asked = _keys(spark, ["p1-3"])
    (batch, bucket), = [x for x in ledger.places(asked) if x[0] == 1]
    held = ledger.known(asked)
    assert [r.path for r in held.collect()] == ["p1-3"]
    scanned = [f for f in held._jdf.queryExecution().optimizedPlan().toString().splitlines() if "batch" in f]
    assert any(f"= {batch}" in f and f"= {bucket}" in f for f in scanned)


def test_ledger_replay_retry_and_empty(spark, tmp_path):
    ledger = KeyLedger(spark, str(tmp_path / "l"), buckets=4)
    asked = _keys(spark, ["a", "b", "c"])
    assert ledger.unprocessed(asked).count() == 3
    done = spark.createDataFrame([("a", "ok"), ("b", "retry"), (None, "ok"), ("c", None)], "path string, status string")
    for _ in range(2):  # a replay
        ledger.add(done, 7)
    assert [r.path for r in ledger.unprocessed(asked).collect()] == ["b"]
    ledger.add(_keys(spark, []), 8)
    ledger.add(spark.createDataFrame([("b", "ok")], "path string, status string"), 9)
    assert ledger.unprocessed(asked).count() == 0

"""Keyed tables: files that stay, files that are skipped, writes that fail."""

from __future__ import annotations

import os
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.lineage import stored
from newsloom.sources.keyed import KeyedTable, WriteConflict, _joined_bits, _places

ROOT = Path(__file__).resolve().parent.parent
SCHEMA = "run_id string, id long, hash string, n int"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "kept"), SCHEMA, ["run_id", "id"], ["hash"], rows_per_file=50)


def rows(spark, ids, n, run="r"):
    return spark.createDataFrame([(run, i, f"h{i * 7919 % 1000:04d}", n) for i in ids], SCHEMA).repartitionByRange(4, "id")


def test_upserts_keep_files_without_their_keys(spark, table):
    table.upsert(rows(spark, range(400), 1), ["n"])
    before = table.files()
    assert len(before) >= 8 and table.version() == 1
    table.upsert(rows(spark, [3, 5, 1000], 2), ["n"])
    after = table.files()
    gone = set(before) - set(after)
    # one file held both keys
    assert len(gone) == 1 and len(set(after) - set(before)) >= 1
    got = {(r.run_id, r.id): r.n for r in table.read().collect()}
    assert got == {("r", i): 2 if i in (3, 5, 1000) else 1 for i in [*range(400), 1000]}
    # the version before is still what it was
    assert {r.n for r in table.read(1).collect()} == {1} and table.read(1).count() == 400


def test_only_named_columns_of_known_keys_change(spark, table):
    table.upsert(rows(spark, range(5), 1), ["n"])
    table.upsert(rows(spark, range(3, 7), 9).withColumn("hash", F.lit("new")), ["n"])
    got = {r.id: (r.hash, r.n) for r in table.read().collect()}
    assert got[4] == ("h0676", 9) and got[6] == ("new", 9) and got[0][1] == 1


def test_look_ups_open_few_files(spark, table):
    ids = list(range(600))
    random.Random(1).shuffle(ids)
    table.upsert(rows(spark, ids, 1), ["n"])
    files = table.files()
    names = {i: f"h{i * 7919 % 1000:04d}" for i in ids}
    for i in (0, 17, 599):
        opened = table.files_with("hash", [names[i]])
        assert len(opened) <= 3 < len(files)
        found = table.look_up("hash", [names[i]])
        assert sorted(r.id for r in found.collect()) == sorted(k for k in ids if names[k] == names[i])
        assert len(found.inputFiles()) == len(opened)
    assert table.files_with("hash", ["h9999x"]) == [] and table.look_up("hash", ["h9999x"]).collect() == []
    assert table.files_with("hash", []) == [] == table.files_with("hash", [None])
    with pytest.raises(ValueError):
        table.files_with("n", [1])


def test_inserts_ignore_known_keys_and_append(spark, table):
    table.insert_new(rows(spark, range(100), 1))
    before = table.files()
    source = rows(spark, range(90, 130), 2).unionByName(rows(spark, range(120, 130), 3))
    table.insert_new(source, F.col("n"))
    assert set(before) <= set(table.files())
    assert {r.id: r.n for r in table.read().collect()} == {i: 1 if i < 100 else 2 for i in range(130)}
    version = table.version()
    table.insert_new(rows(spark, range(50), 5))
    assert table.version() == version


def test_first_inserts_of_stored_rows_copy_none(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr("newsloom.lineage.checkpoint_dir", lambda spark: str(tmp_path / "copies"))
    source = stored(rows(spark, range(100), 1).unionByName(rows(spark, [7, 8], 0)), "source")
    table.insert_new(source, F.col("n"))
    assert {r.id: r.n for r in table.read().collect()} == {i: 0 if i in (7, 8) else 1 for i in range(100)}
    copies = [spark.read.parquet(str(path)).columns for path in (tmp_path / "copies").iterdir() if not path.name.startswith("source-")]
    assert not [columns for columns in copies if "hash" in columns]


def test_deletes_copy_no_rows(spark, table, tmp_path, monkeypatch):
    table.insert_new(rows(spark, range(100), 1).unionByName(rows(spark, range(100), 2, "s")))
    monkeypatch.setattr("newsloom.lineage.checkpoint_dir", lambda spark: str(tmp_path / "copies"))
    table.delete("run_id", ["r"])
    assert {(r.run_id, r.n) for r in table.read().collect()} == {("s", 2)} and table.read().count() == 100
    assert not (tmp_path / "copies").exists()


def test_many_keys_are_found_without_filters(spark, table, monkeypatch):
    monkeypatch.setattr("newsloom.sources.keyed.FILTERED_KEYS", 3)
    table.upsert(rows(spark, range(100), 1), ["n"])
    table.upsert(rows(spark, range(60, 140), 2), ["n"])
    assert {r.id: r.n for r in table.read().collect()} == {i: 1 if i < 60 else 2 for i in range(140)}


def test_a_write_that_dies_leaves_the_old_state(spark, table, monkeypatch):
    table.upsert(rows(spark, range(20), 1), ["n"])
    files = table.files()

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_commit", die)
        with pytest.raises(RuntimeError):
            table.upsert(rows(spark, range(20), 2), ["n"])
    assert table.files() == files and {r.n for r in table.read().collect()} == {1}
    # a version is made once; who comes second fails and changes nothing
    table.upsert(rows(spark, [1], 7), ["n"])
    with pytest.raises(WriteConflict):
        table._commit(table._manifest(1), 2)
    assert {r.id: r.n for r in table.read().collect()}[1] == 7 and table.version() == 2


def test_empty_tables_and_nulls(spark, table):
    assert table.read().collect() == [] and table.version() == 0
    empty = rows(spark, [1], 1).limit(0)
    table.insert_new(empty)
    assert table.version() == 0
    table.upsert(empty, ["n"])
    assert table.read().collect() == []
    table.upsert(spark.createDataFrame([("r", 1, None, None), ("r", 2, "x", 1)], SCHEMA), ["n"])
    assert [r.id for r in table.look_up("hash", ["x"]).collect()] == [2] and table.read().count() == 2


def test_small_files_join_the_next_write(spark, tmp_path):
    small = KeyedTable(spark, str(tmp_path / "kept"), SCHEMA, ["run_id", "id"], ["hash"], rows_per_file=50, merge_below=20)
    for i in range(4):
        small.upsert(rows(spark, [i], i).coalesce(1), ["n"])
    assert len(small.files()) == 1
    small.insert_new(rows(spark, range(3, 6), 9).coalesce(1))
    assert {r.id: r.n for r in small.read().collect()} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 9, 5: 9}
    # full files are left alone
    small.upsert(rows(spark, range(100, 160), 1).coalesce(1), ["n"])
    full = set(small.files())
    small.upsert(rows(spark, [7], 1).coalesce(1), ["n"])
    assert len(full & set(small.files())) >= 1 and small.read().count() == 67


def test_deletes_replace_only_files_with_the_value(spark, table):
    table.delete("run_id", ["r"])
    assert table.version() == 0
    table.upsert(rows(spark, range(200), 1).union(rows(spark, range(10), 1, "s")), ["n"])
    before = set(table.files())
    table.delete("run_id", ["s", "unknown"])
    assert table.read().filter("run_id = 's'").count() == 0 and table.read().count() == 200
    assert 0 < len(before - set(table.files())) < len(before)
    version = table.version()
    table.delete("run_id", ["s"])
    assert table.version() == version
    table.delete("run_id", ["r"])
    assert table.read().count() == 0 and table.look_up("hash", ["h0000"]).count() == 0
    table.upsert(rows(spark, [1], 5), ["n"])
    assert [r.n for r in table.read().collect()] == [5]


def test_filters_of_any_sizes_join_without_losing_values():
    values = np.random.default_rng(1).integers(-(2**62), 2**62, (2, 90))
    parts = []
    for n_bits, some in [(256, slice(0, 10)), (1024, slice(10, 40)), (4096, slice(40, 90))]:
        bits = np.zeros(n_bits, np.uint8)
        bits[_places(values[0, some], values[1, some], n_bits).ravel()] = 1
        parts.append(np.packbits(bits, bitorder="little"))
    for size in (8, 64, 512, 4096):
        joined = np.unpackbits(_joined_bits(parts, size), bitorder="little")
        assert len(joined) == 8 * min(size, 512)
        assert joined[_places(values[0], values[1], len(joined))].all()


def test_workers_find_the_package_from_any_folder(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from newsloom.session import local_session
from newsloom.sources.keyed import KeyedTable
spark = local_session("2", spark__checkpoint__dir={str(tmp_path / "shared")!r})
kept = KeyedTable(spark, {str(tmp_path / "kept")!r}, {SCHEMA!r}, ["id"])
kept.upsert(spark.createDataFrame([("r", 1, "h", 2)], {SCHEMA!r}), ["n"])
print("found", kept.look_up("id", [1]).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "found 1" in done.stdout, done.stderr[-2000:]

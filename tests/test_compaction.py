"""Merged batches: the same rows in fewer files, replayed without a surplus."""

import glob
import tempfile

import pytest

from abiflow.plans.pipeline import run_batch
from abiflow.sources import sinks
from test_plans import history


def rows(spark, root):
    return {name: sorted(map(str, sinks.read_table(spark, root, name).drop("params").select("batch_id", "arrival_seq", "block_number").collect())) for name in sinks.TABLES}


def write(spark, root, batch_id, blocks):
    inp = history(spark, 20)
    inp.notices = spark.createDataFrame([(b, b) for b in blocks], "arrival_seq bigint, block_number bigint")
    out = run_batch(inp)
    try:
        sinks.write_run(out, root, batch_id)
    finally:
        out.release()


@pytest.fixture(scope="module")
def merged(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for k in range(5):
        write(spark, root, k, [3 * k, 3 * k + 1])
    before = rows(spark, root)
    done = sinks.compact(spark, root)
    return root, before, done


def test_merged_batches_hold_the_same_rows_in_few_files(spark, merged):
    root, before, done = merged
    assert done == (0, 3) and rows(spark, root) == before
    assert sinks.compact(spark, root) is None  # the newest stays as it is
    files = sinks.read_table(spark, root, sinks.EVENTS).where("batch_id < 4").inputFiles()
    assert len([f for f in files if "_merged" in f]) < len(glob.glob(f"{root}/{sinks.EVENTS}/batch_id=[0-3]/*.parquet")) + 1


def test_a_replayed_batch_takes_the_place_of_its_merged_rows(spark, merged):
    root, before, _ = merged
    write(spark, root, 1, [3])  # now without its second block
    after = rows(spark, root)
    want = {name: [r for r in v if "batch_id=1," not in r or "block_number=3" in r] for name, v in before.items()}
    assert after == want and after[sinks.EVENTS] != before[sinks.EVENTS]
    assert sinks.vacuum(spark, root) == 3 * len(sinks.TABLES)  # 0, 2 and 3
    assert rows(spark, root) == want
    write(spark, root, 5, [18])
    assert sinks.compact(spark, root) == (4, 4) and len(sinks.manifest(spark, root, sinks.EVENTS).sets) == 2
    assert [r for r in rows(spark, root)[sinks.EVENTS] if "batch_id=5" not in r] == want[sinks.EVENTS]


def test_a_failed_compaction_changes_nothing(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for k in range(3):
        write(spark, root, k, [k])
    before = rows(spark, root)
    enter = sinks._enter
    monkeypatch.setattr(sinks, "_enter", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        sinks.compact(spark, root)
    assert rows(spark, root) == before
    monkeypatch.setattr(sinks, "_enter", enter)
    assert sinks.compact(spark, root) == (0, 1) and rows(spark, root) == before

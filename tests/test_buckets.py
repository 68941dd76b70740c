"""State in buckets: what a batch reads does not grow with keys it does not touch."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from bedwatch.session import matching_paths
from bedwatch.sinks.buckets import BucketLog

SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.LongType())])


def rows(spark, pairs):
    return spark.createDataFrame(pairs, SCHEMA).coalesce(1)


def bucket_of(spark, log, key):
    return rows(spark, [(key, 0)]).select(log.bucket().alias("b")).first()["b"]


def test_files_read_do_not_grow_with_other_keys(spark, folder):
    log = BucketLog(folder, ("key",), 16)
    log.write(rows(spark, [("mine", 1)]), 0)
    own = bucket_of(spark, log, "mine")
    before = len(log.read(spark, SCHEMA, [own]).inputFiles())
    others = [k for k in (f"k{i}" for i in range(400)) if bucket_of(spark, log, k) != own][:60]
    for n in range(1, 5):
        log.write(rows(spark, [(k, n) for k in others]), n)
    read = log.read(spark, SCHEMA, [own])
    assert len(read.inputFiles()) == before == 1 and [tuple(r) for r in read.collect()] == [("mine", 1)]
    assert len(log.read(spark, SCHEMA).inputFiles()) > 20


@pytest.mark.parametrize("every", [0, 3])
def test_log_equals_a_dictionary(spark, folder, every):
    rnd, log, want, history = random.Random(1), BucketLog(folder, ("key",), 4, every), {}, []
    for n in range(11):
        some = {f"k{rnd.randrange(9)}": rnd.randrange(100) for _ in range(rnd.randrange(5))}
        log.write(rows(spark, list(some.items())), n)
        want = {**want, **some}
        history.append(dict(want))
    read = lambda **how: {r["key"]: r["value"] for r in log.read(spark, SCHEMA, **how).collect()}
    assert read() == want and read(below=10) == history[9]
    for b in range(4):
        part = log.read(spark, SCHEMA, [b])
        assert ({r["key"]: r["value"] for r in part.collect()} if part else {}) == {
            k: v for k, v in want.items() if bucket_of(spark, log, k) == b}
    if every:
        assert len(matching_paths(spark, f"{folder}/changes/batch_id=*")) <= 2 * every + 1


def test_only_touched_buckets_are_folded_and_a_batch_may_run_again(spark, folder):
    log = BucketLog(folder, ("key",), 8)
    log.write(rows(spark, [(f"k{i}", i) for i in range(30)]), 0)
    assert len(log.compact(spark, SCHEMA, 0)) > 4
    log.write(rows(spark, [("k1", 100), ("k2", 200)]), 1)
    log.write(rows(spark, [("k1", 101)]), 1)  # again, with fewer keys
    assert log.compact(spark, SCHEMA, 1) == [bucket_of(spark, log, "k1")]
    got = {r["key"]: r["value"] for r in log.read(spark, SCHEMA).collect()}
    assert got == {**{f"k{i}": i for i in range(30)}, "k1": 101}
    assert log.read(spark, SCHEMA, below=0) is None

"""Stored key tables and attempts spaced in time."""

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import planning as PL
from corpusmill.sources.stored import KeyStore
from corpusmill.streaming import retries as RT


@pytest.fixture()
def no_broadcast(spark):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_is_not_shuffled(no_broadcast, tmp_path):
    spark = no_broadcast
    store = KeyStore(str(tmp_path), buckets=4)
    files = spark.range(200).select(F.concat(F.lit("p"), "id").alias("path"), (F.col("id") * 10).alias("length"))
    assert store.read(spark).count() == 0
    store.append(files.where("length < 500"))
    store.append(files.where("length between 400 and 900"))  # some for the second time
    store.append(files.where("false"))
    wanted = spark.range(150).select(F.concat(F.lit("p"), "id").alias("path"))
    pending, present = PL.pending(wanted, store.read(spark)), PL.mark_present(wanted, store.read(spark), min_bytes=500)
    assert pending.count() == 150 - 91
    assert present.count() == 150 and present.where("present").count() == 40
    for df in (pending, present):
        assert _plan(df).count("Exchange hashpartitioning") == 1  # the wanted side alone
        assert "Bucketed: true" in _plan(df)


def test_table_is_found_by_another_session(spark, tmp_path):
    store = KeyStore(str(tmp_path), schema="path STRING", buckets=4)
    store.append(spark.createDataFrame([("a",), (None,), ("b",)], "path STRING"))
    other = spark.newSession()
    other.sql(f"DROP TABLE {store.table}")  # an entry of the catalogue; the files stay
    assert sorted(r.path for r in store.read(other).collect()) == ["a", "b"]
    store.append(other.createDataFrame([("c",)], "path STRING"))
    assert sorted(r.path for r in store.read(spark).collect()) == ["a", "b", "c"]


def _convert(df):
    return df.select("id", F.when(F.col("doc").isNull(), "error").otherwise("ok").alias("status"))


def _log(spark, state):
    return spark.read.parquet(f"{state}/attempts")


def test_attempts_are_spaced_and_limited(spark, tmp_path):
    state = str(tmp_path / "state")
    docs = spark.createDataFrame([(1, "x"), (2, None), (3, None), (None, None)], "id INT, doc STRING")
    fixed = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id INT, doc STRING")
    RT.log_attempts(_convert(docs), "id", 1, state, 0)
    q = RT.start_retries(spark, lambda: fixed, _convert, "id", state, 0.5, poll="200 milliseconds")
    assert RT.run_until_settled(q, 120)
    got = {r.id: (r.status, r.attempts) for r in RT.outcome(spark, state, "id").where("id is not null").collect()}
    assert got == {1: ("ok", 1), 2: ("ok", 2), 3: ("error", 4)}
    at = [r.at.timestamp() for r in _log(spark, state).where("id = 3").orderBy("attempt").collect()]
    waits = [b - a for a, b in zip(at, at[1:])]
    assert all(wait >= unit * 0.5 for wait, unit in zip(waits, (2, 4, 8)))


def test_goes_on_after_a_restart(spark, tmp_path):
    state = str(tmp_path / "state")
    docs = spark.createDataFrame([(1, None), (2, None)], "id INT, doc STRING")
    RT.log_attempts(_convert(docs), "id", 1, state, 0)
    gone = docs.where("id = 1")  # document 2 is no longer there
    q = RT.start_retries(spark, lambda: gone, _convert, "id", state, 0.4, poll="200 milliseconds")
    assert not RT.run_until_settled(q, 2.5)
    q = RT.start_retries(spark, lambda: gone, _convert, "id", state, 0.4, poll="200 milliseconds")
    assert RT.run_until_settled(q, 120)
    log = sorted((r.id, r.attempt, r.status) for r in _log(spark, state).collect())
    assert log == [(i, n, "error") for i in (1, 2) for n in (1, 2, 3, 4)]


def test_all_good_settles_at_once(spark, tmp_path):
    state = str(tmp_path / "state")
    docs = spark.createDataFrame([(1, "x")], "id INT, doc STRING")
    RT.log_attempts(_convert(docs), "id", 1, state, 0)
    q = RT.start_retries(spark, lambda: docs, _convert, "id", state, 0.4, poll="200 milliseconds")
    assert RT.run_until_settled(q, 60)
    assert _log(spark, state).count() == 1

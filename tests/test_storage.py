"""Ledger, lookup, sinks, stored models, shared folder and the stream."""

from __future__ import annotations

import os
from datetime import date, datetime

import pytest

from slotflow.functions.checks import unique
from slotflow.operators import ledger as L
from slotflow.session import materialize, materialize_all, shared_folder, temporary_tables
from slotflow.sources import sinks
from slotflow.streaming.messages import ingest_price_lines, stream_files
from test_prices import record

MOVES = "licenceplate string, target_state_name string"


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_ledger(spark):
    rows = [("T1", "Z-MOVE_OSR"), ("T2", "Z-MOVE_ASRS"), ("T3", None)]
    ledger = spark.createDataFrame(rows[:2], MOVES)
    added = L.ledger_insert(ledger, spark.createDataFrame([("T3", 1, None)], "licenceplate string, x int, target_state_name string"))
    assert pairs(added.fillna("-")) == [("T1", "Z-MOVE_OSR"), ("T2", "Z-MOVE_ASRS"), ("T3", "-")]
    assert pairs(L.ledger_delete(added, "Z-MOVE_OSR").fillna("-")) == [("T2", "Z-MOVE_ASRS"), ("T3", "-")]
    assert L.ledger_delete(added).count() == 0


def test_stored_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    L.create_ledger(spark, path)
    assert L.read_ledger(spark, path).count() == 0
    first = spark.createDataFrame([("T1", "Z-MOVE_OSR"), ("T2", "Z-MOVE_ASRS"), ("T3", None)], MOVES)
    for _ in range(2):  # a batch that is run again replaces itself
        L.commit_insert(first, path, 1)
    assert L.read_ledger(spark, path).count() == 3
    L.commit_delete(spark, path, 2, "Z-MOVE_OSR")
    L.commit_insert(spark.createDataFrame([("T4", "Z-MOVE_OSR")], MOVES), path, 3)
    assert pairs(L.read_ledger(spark, path).fillna("-")) == [("T2", "Z-MOVE_ASRS"), ("T3", "-"), ("T4", "Z-MOVE_OSR")]
    L.commit_delete(spark, path, 4)
    L.commit_insert(first.limit(1), path, 5)
    assert pairs(L.read_ledger(spark, path)) == [("T1", "Z-MOVE_OSR")]


def test_lookup_has_a_row_per_instruction(spark):
    moves = spark.createDataFrame([("T1", "a"), ("T1", "a"), ("T2", "b")], MOVES)
    stock = spark.createDataFrame([("T1", "B"), ("T1", "A"), ("T1", "B"), ("T2", "C"), ("T9", "D")], "licenceplate string, item_number string")
    found = sorted((r.licenceplate, r.prod_ids) for r in L.tote_product_lookup(moves, stock).collect())
    assert found == [("T1", ["A", "B"]), ("T1", ["A", "B"]), ("T2", ["C"])]


def test_feature_days_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "features")
    schema = "insert_date date, prod_id string, v long"
    first, second = date(2024, 5, 1), date(2024, 5, 2)
    sinks.refresh_features(spark.createDataFrame([(first, "a", 1), (first, "b", 1)], schema), path)
    for _ in range(2):
        sinks.refresh_features(spark.createDataFrame([(second, "a", 2)], schema), path)
    sinks.refresh_features(spark.createDataFrame([(first, "a", 3)], schema), path)
    assert pairs(spark.read.parquet(path).select("insert_date", "prod_id", "v")) == [(first, "a", 3), (second, "a", 2)]


def test_training_table_is_replaced(spark, tmp_path):
    for value in (1, 2):
        sinks.refresh_training(spark.createDataFrame([(value,)], "v long"), "training_of_test", str(tmp_path / "training"))
        assert pairs(spark.table("training_of_test")) == [(value,)]


def test_moves_are_written_in_declared_types(spark, tmp_path):
    path = str(tmp_path / "moves")
    rows = [("T1", "Z-MOVE_OSR", "Z-ABIN2BIN", "2024-05-01 17:15:00", "10")]
    columns = "licenceplate string, target_state_name string, source_zone_name string, timestamp string, status string"
    for _ in range(2):
        sinks.write_moves(spark.createDataFrame(rows, columns), path)
    back = spark.read.parquet(path)
    assert dict(back.dtypes) == {**sinks.MOVE_TYPES, "status": "bigint"}
    assert pairs(back) == [("T1", "Z-MOVE_OSR", "Z-ABIN2BIN", datetime(2024, 5, 1, 17, 15), 10)]


def test_unique_stops_on_a_repeated_key(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    assert pairs(unique(df, "k")) == [("a", 1), ("b", 2)]
    with pytest.raises(Exception, match="k occurs more than once: a"):
        unique(df.union(df.filter("k = 'a'")), "k").collect()


def test_materialized_frames_have_no_lineage(spark):
    stored = materialize(spark.range(10).selectExpr("id * 2 as v"))
    assert materialize(stored) is stored
    assert "Range" not in stored._jdf.queryExecution().toString()
    both = materialize_all(spark.range(3).toDF("v"), spark.range(4).toDF("v"))
    assert [df.count() for df in both] == [3, 4]
    assert shared_folder(spark)


def test_temporary_tables_are_removed(spark):
    with temporary_tables(spark):
        stored = [materialize(spark.range(3)), *materialize_all(spark.range(4), spark.range(5))]
        paths = [df.inputFiles()[0].removeprefix("file:").removeprefix("//") for df in stored]
        assert all(os.path.exists(p) for p in paths)
    assert not any(os.path.exists(p) for p in paths)
    outside = materialize(spark.range(6))
    assert outside.count() == 6


def test_stream_reads_each_file_once(spark, tmp_path):
    source, lines, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))

    def arrive(*prods):
        message = "|".join(record(prodid=p) for p in prods)
        spark.createDataFrame([(message,)], "raw_message string").coalesce(1).write.mode("append").parquet(source)

    for prods in (("00000001", "00000002"), ("00000003",)):
        arrive(*prods)
        stream = stream_files(spark, source, spark.read.parquet(source).schema, "*.parquet")
        ingest_price_lines(stream, lines, progress).awaitTermination()
    assert [r.prodid for r in spark.read.parquet(lines).orderBy("prodid").collect()] == ["00000001", "00000002", "00000003"]

import json

import pytest
from conftest import rows
from matches import FIRST, SECOND
from pyspark.sql import functions as F

from matchlake.operators.enrich import merge_timings
from matchlake.operators.maintain import Unique, apply_corrections, assign_key, audit, dedupe, upsert
from matchlake.sources.documents import parse_documents, stage_documents
from matchlake.sources.people import load_players, read_people
from matchlake.sources.snapshots import restore, snapshot, write_ball_fact
from matchlake.streaming.staging import stage_new_files, staged


def write(folder, name, text):
    (folder / name).write_text(text)


def test_json_folder(spark, tmp_path):
    write(tmp_path, "1.json", json.dumps(FIRST, indent=1))
    write(tmp_path, "2.json", "{broken")
    write(tmp_path, "3.json", "")
    write(tmp_path, "note.txt", "x")
    good, bad = stage_documents(spark, str(tmp_path))
    assert rows(good, "id") == [("1",)] and rows(bad, "id") in ([("2",)], [("2",), ("3",)])
    doc = parse_documents(good).first()
    assert doc.info.officials == {"umpires": ["G One", "H One"], "referee": ["G One"]}


def test_incremental_staging(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    write(source, "1.json", json.dumps(FIRST))
    write(source, "9.json", "nope")
    stage_new_files(spark, str(source), target, state).awaitTermination(120)
    write(source, "2.json", json.dumps(SECOND))
    stage_new_files(spark, str(source), target, state).awaitTermination(120)
    stage_new_files(spark, str(source), target, state).awaitTermination(120)
    assert rows(staged(spark, target), "id") == [("1",), ("2",)]


def test_people_csv(spark, tmp_path):
    write(tmp_path, "p.csv", 'identifier,name,unique_name,key_cricinfo,extra\np1,"A, One",A One,,7\n,B,B,1,\np2,C,C,5,\n')
    people = read_people(spark, str(tmp_path / "p.csv"))
    assert rows(people, "identifier", "name", "key_cricinfo", "extra") == [("p1", "A, One", None, "7"), ("p2", "C", "5", None)]
    known = load_players(people.where("identifier = 'p1'")).withColumn("name", F.col("name"))
    again = load_players(people, known)
    assert rows(again, "identifier") == [("p1",), ("p2",)]


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, x string, y int")
    new = spark.createDataFrame([(2, None, 9), (3, "c", 3)], "k int, x string, y int")
    assert rows(upsert(old, new, ["k"], "overwrite")) == [(1, "a", 1), (2, None, 9), (3, "c", 3)]
    assert rows(upsert(old, new, ["k"], "ignore")) == [(1, "a", 1), (2, "b", 2), (3, "c", 3)]
    assert rows(upsert(old, new, ["k"], "coalesce")) == [(1, "a", 1), (2, "b", 9), (3, "c", 3)]
    part = new.select("k", "x")
    assert rows(upsert(old, part, ["k"], "overwrite")) == [(1, "a", 1), (2, None, 2), (3, "c", None)]
    once = upsert(old, new, ["k"], "overwrite")
    assert rows(upsert(once, new, ["k"], "overwrite")) == rows(once)


def test_dedupe_first_and_last(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "b"), (2, 5, "c")], "k int, o int, v string")
    assert rows(dedupe(df, ["k"], ["o"], "last")) == [(1, 2, "b"), (2, 5, "c")]
    assert rows(dedupe(df, ["k"], ["o"], "first")) == [(1, 1, None), (2, 5, "c")]


def test_keys_are_dense_and_stable(spark):
    names = spark.createDataFrame([(f"n{i}",) for i in range(300)] + [(None,)], "name string")
    first = assign_key(names.where("name < 'n2'"), ["name"], "id")
    both = assign_key(names, ["name"], "id", first)
    assert sorted(r.id for r in both.collect()) == list(range(1, 301))
    assert set(rows(first)) <= set(rows(both))


def test_a_null_in_a_key_is_given_once(spark):
    pairs = spark.createDataFrame([("a", None), ("a", "x"), (None, "x")], "name string, city string")
    first = assign_key(pairs, ["name", "city"], "id")
    assert rows(assign_key(pairs, ["name", "city"], "id", first)) == rows(first) and first.count() == 2
    assert rows(audit({"t": pairs.union(pairs)}, [Unique("t", ("name", "city"))]), "key", "n") == [("a|x", 2)]


def test_repeated_rows_of_one_key_count_once(spark, tmp_path):
    (tmp_path / "twice.csv").write_text("identifier,name,unique_name,key_cricinfo\np1,Old,O,1\np2,B,B,2\np1,New,N,1\n")
    people = read_people(spark, str(tmp_path / "twice.csv"))
    assert rows(people, "identifier", "name") == [("p1", "New"), ("p2", "B")]
    assert load_players(people.unionByName(people)).count() == 2
    known = spark.createDataFrame([(1, 5, None), (2, 6, None)], "inning_id int, a int, b int")
    new = spark.createDataFrame([(1, 7, None, 1), (1, None, 8, 2), (1, 3, None, 3)], "inning_id int, a int, b int, at int")
    assert rows(merge_timings(known, new, ["at"])) == [(1, 3, 8), (2, 6, None)]


def test_corrections(spark):
    players = spark.createDataFrame([("a", "x", None), ("b", "y", "1")], "k string, name string, born string")
    fixes = spark.createDataFrame([("a", None, "2000-01-01"), ("z", "q", None)], "k string, name string, born string")
    assert rows(apply_corrections(players, fixes, "k")) == [("a", "x", "2000-01-01"), ("b", "y", "1")]


def test_snapshots(spark, tmp_path):
    df = spark.range(5)
    path = snapshot(df, str(tmp_path), "players", "s1")
    with pytest.raises(Exception):
        snapshot(df, str(tmp_path), "players", "s1")
    assert restore(spark, path, str(tmp_path / "players")).count() == 5


def test_ball_fact_is_read_by_season(spark, tmp_path):
    df = spark.range(100).selectExpr("id % 5 + 2000 AS season_year", "id AS match_id", "id AS runs")
    write_ball_fact(df, str(tmp_path / "balls"))
    one = spark.read.parquet(str(tmp_path / "balls")).where("season_year = 2001")
    assert one.count() == 20
    assert "PartitionFilters: [isnotnull(season_year" in one._jdf.queryExecution().executedPlan().toString()

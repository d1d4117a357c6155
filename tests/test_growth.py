"""Plans that must not grow faster than their input."""

from conftest import rows
from matches import staged
from pyspark.sql import functions as F

from matchlake.operators.maintain import KEY_RANGES, ForeignKey, audit
from matchlake.operators.normalise import balls
from matchlake.plans import tables
from matchlake.plans.catalogue import QUERIES
from matchlake.plans.tables import Tables
from matchlake.plans.text_matches import match_counts, match_documents
from matchlake.session import configure
from matchlake.sources.documents import number_matches, parse_documents, with_key_counts

WORDS = ["Abc,", "x.", "Zebra", "[odd", "mid11letter", "Abcdefghijkl", "Éa", "fourteen14chr", "a", "Thirteenchars"]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def texts(spark):
    data = [(i, " ".join((WORDS * 3)[: 3 * i]), "en", "web", 10 + i) for i in range(8)] + [(8, None, "en", "web", 15)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")


def test_counts_are_stored_before_they_are_summed(spark):
    numbers = number_matches(with_key_counts(parse_documents(staged(spark))))
    assert "from_json" not in plan(numbers) and plan(numbers).count("LogicalRDD") <= 6


def test_balls_are_picked_by_place(spark):
    documents = match_documents(texts(spark))
    assert "slice(words" not in plan(documents)
    counted = with_key_counts(documents.where("match_no < 8"))
    assert rows(counted, "match_id", *KEY_RANGES) == rows(match_counts(texts(spark)).where("match_no < 8"), "match_id", *KEY_RANGES)
    overs = documents.selectExpr("match_no", "innings[0].overs AS overs").where("match_no = 7").first().overs
    assert [o.over for o in overs] == [0, 1] and [len(o.deliveries) for o in overs] == [6, 4]
    ball = overs[0].deliveries[0]
    assert (ball.batter, ball.bowler, ball.runs.total, ball.extras.wides, ball.runs.non_boundary, len(ball.wickets)) == ("A", "len4", 5, 1, True, 1)
    tie_break = documents.where("match_no = 8").selectExpr("innings[2].overs[0].deliveries AS balls").first()
    assert tie_break.balls is None


def test_balls_are_made_on_columns_of_words(spark):
    documents = match_documents(texts(spark))
    assert "MapInArrow" in plan(documents) and "transform(words" not in plan(documents)


def test_letters_of_several_bytes_and_odd_spaces(spark):
    odd = [(0, "\tÉa 漢字漢. \r\n🙂x 9b\x0bc", "en", "web", 10), (1, "", "en", "web", 10), (2, None, "en", "web", 10)]
    data = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    made = match_documents(data).selectExpr(
        "match_no", "flatten(flatten(innings.overs).deliveries) AS balls", "map_keys(info.registry.people) AS people", "innings.target.runs AS sizes").collect()
    first, empty, missing = sorted(made, key=lambda r: r.match_no)
    assert [(b.batter, b.bowler, b.non_striker, b.extras.noballs) for b in first.balls] == 2 * [
        ("É", "len2", "a", None), ("漢", "len4", ".", 1), ("🙂", "len2", "x", None), ("9", "len4", "c", None)]
    assert first.people == ["É", "漢", "🙂", "a", ".", "x", "c", "len2", "len4"] and first.sizes == [2, 2, 4]
    assert (empty.balls, empty.sizes) == ([], [0, 0, 0]) and (missing.people, missing.sizes) == (None, [None, None, 6])


def test_names_are_looked_up_in_parts_of_a_registry(spark):
    words = " ".join(chr(0x61 + i % 26) + "x" * (i % 30) + chr(0x61 + i % 25) for i in range(300))
    docs = match_documents(spark.createDataFrame([(1, words, "en", "web", 10)], "doc_id long, text string, lang string, source string, n_chars long"))
    found = balls(docs.selectExpr("*", *[f"0L AS {c}" for c in KEY_RANGES.values()]))
    assert "map_filter" in plan(found)
    expected = [("p:" + w[0], f"p:len{len(w)}", "p:" + w[-1]) for w in words.split() + words.split()[:6]]
    assert [tuple(r) for r in found.orderBy("delivery_id").select("batter", "bowler", "non_striker").collect()] == expected


def test_innings_need_the_documents_once(spark, tmp_path, monkeypatch):
    texts(spark).write.parquet(str(tmp_path / "documents.parquet"))
    built = []
    monkeypatch.setattr(tables, "match_documents", lambda documents: built.append(1) or match_documents(documents))
    assert QUERIES["norm_innings"](Tables(spark, str(tmp_path))).count() > 0
    assert len(built) == 1


def test_players_are_looked_up_by_side_and_matches_are_not_broadcast(spark, tmp_path):
    texts(spark).write.parquet(str(tmp_path / "documents.parquet"))
    players = QUERIES["norm_match_players"](Tables(spark, str(tmp_path)))
    steps = plan(players)
    # Plans read from the top, so the people become rows after the teams are joined.
    assert steps.index("player_identifier") < steps.rindex("explode(people") < steps.index("Join")
    found = {(r.match_id, r.player_identifier): r.team_id for r in players.collect()}
    assert "BuildLeft" not in players._jdf.queryExecution().executedPlan().toString()
    # Match 1 is "Abc, x. Zebra": batters A, x and Z, bowlers of lengths 4, 2 and 5.
    assert {who for match, who in found if match == "1"} == {"p:A", "p:x", "p:Z", "p:len4", "p:len2", "p:len5"}
    assert found["1", "p:A"] == found["1", "p:x"] != found["1", "p:len4"]


def test_texts_without_words_have_no_raw_balls(spark, tmp_path):
    texts(spark).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["an_raw_json_deliveries"](Tables(spark, str(tmp_path)))
    counts = {r.match_id: r["count"] for r in found.groupBy("match_id").count().collect()}
    # Match 0 has no words; match 5 has a tie-break of six balls.
    assert counts == {str(i): 3 * i + 6 * (i == 5) for i in range(1, 8)}


def test_texts_without_words_have_no_officials(spark, tmp_path):
    texts(spark).where("doc_id < 2").write.parquet(str(tmp_path / "documents.parquet"))
    officials = QUERIES["norm_officials"](Tables(spark, str(tmp_path)))
    # Match 1 is "Abc, x. Zebra": bowlers of lengths 4 and 2 are the umpires.
    assert rows(officials, "match_id", "official_identifier", "match_role") == [
        ("1", "p:,", "referee"), ("1", "p:len2", "umpires"), ("1", "p:len4", "umpires")]


def test_parents_of_foreign_keys_are_not_broadcast(spark, tmp_path):
    # A file of 10,000 keys in a row is small, however many rows the driver would have to hold.
    spark.range(10_000).withColumnRenamed("id", "match_id").write.parquet(str(tmp_path / "matches"))
    innings = spark.createDataFrame([(5,), (10_000,), (10_000,), (None,)], "match_id long")
    found = audit(
        {"innings": innings, "matches": spark.read.parquet(str(tmp_path / "matches"))},
        [ForeignKey("innings", ("match_id",), "matches", ("match_id",))])
    assert rows(found) == [("in matches", "innings", "10000", 2)]
    steps = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in steps and "SortMergeJoin" in steps


def test_larger_tables_make_more_tasks(spark, tmp_path):
    configure(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        # About 100 MB that hardly shrink: in tasks of 64 or 128 MB they would come to one a core.
        wide = spark.range(3_000_000).select(F.xxhash64("id").alias("match_id"), *[F.xxhash64("id", F.lit(i)).alias(f"c{i}") for i in range(3)])
        wide.write.option("parquet.block.size", 4 << 20).parquet(str(tmp_path / "wide"))
        read = spark.read.parquet(str(tmp_path / "wide"))
        task, row = F.spark_partition_id().alias("task"), F.max(F.struct(*wide.columns))
        assert len(read.groupBy(task).agg(row).collect()) >= 7
        assert len(read.repartition("match_id").groupBy(task).agg(row).collect()) >= 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")

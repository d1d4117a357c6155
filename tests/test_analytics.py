import pytest
from conftest import rows
from pyspark.sql import functions as F

from matchlake.functions.numbers import ratio
from matchlake.operators import analytics as an

COLUMNS = ("match_id int, inning_id int, inning_number int, is_super_over boolean, season_year int, over_number int, "
           "ball_number int, batter string, non_striker string, bowler string, runs_batter int, runs_total int, wides int, "
           "noballs int, byes int, legbyes int, outs int, striker_outs int, credited_outs int, kind string")


def fact(spark, balls):
    """Balls from (bowler, batter, partner, runs, wides, kind) in order, six to an over."""
    data = []
    for i, (bowler, batter, partner, runs, wide, kind) in enumerate(balls):
        got = int(kind is not None)
        credit = int(kind in ("bowled", "caught"))
        data.append((1, 1, 1, False, 2024, i // 6, i % 6 + 1, batter, partner, bowler, runs, runs + wide, wide, 0, 0, 0,
                     got, got, credit, kind))
    return spark.createDataFrame(data, COLUMNS)


def wicket_line(spark, marks, bowler="x"):
    return fact(spark, [(bowler, "a", "b", 0, int(m == "+"), {"W": "bowled", "R": "run out"}.get(m)) for m in marks])


@pytest.mark.parametrize("marks, count", [
    ("WWW", 1), ("WW.W", 0), ("WWWW", 2), (".WWW.WWW", 2), ("WWRW", 0), ("WW+W", 0), ("....WWW", 1)])
def test_hat_tricks(spark, marks, count):
    assert sum(r.hat_tricks for r in an.hat_tricks(wicket_line(spark, marks)).collect()) == count


def test_hat_trick_balls_of_other_bowlers_do_not_count(spark):
    balls = [("x", "a", "b", 0, 0, "bowled"), ("y", "a", "b", 0, 0, None), ("x", "a", "b", 0, 0, "caught"), ("x", "a", "b", 0, 0, "bowled")]
    assert rows(an.hat_tricks(fact(spark, balls))) == [("x", 1)]


def test_ratio_rounds_half_up_and_survives_zero(spark):
    df = spark.createDataFrame([(1, 8), (5, 0), (2, 3)], "a long, b long")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [0.13, None, 0.67]


def test_partnership_shares(spark):
    balls = [("x", "b", "a", 4, 0, None), ("x", "a", "b", 6, 0, None), ("x", "a", "b", 0, 1, "run out")]
    one = an.partnerships(fact(spark, balls), min_runs=1).first()
    assert (one.player1, one.player2, one.partnership_runs, one.contribution) == ("a", "b", 10, "6 (60%) vs 4 (40%)")
    assert one.run_rate == 30.0 and one.partnership_average is None
    assert an.partnerships(fact(spark, balls), min_runs=1, credited_only=False).first().partnership_average == 10.0


def test_head_to_head_flags(spark):
    balls = [("x", "a", "b", 4, 0, None), ("x", "a", "b", 0, 1, "run out"), ("x", "a", "b", 0, 0, "bowled"), ("x", "a", "b", 0, 0, "caught")]
    one = an.head_to_head(fact(spark, balls), ["x"], min_balls=1).first()
    assert (one.balls, one.outs, one.common_dismissal, one.dot_ball_pct) == (4, 2, "bowled", 75.0)
    strict = an.head_to_head(fact(spark, balls), ["x"], min_balls=1, count_wides=False, credited_only=False).first()
    assert (strict.balls, strict.outs) == (3, 2)


def test_combined_rank_shares_ranks_on_ties(spark):
    balls = [("x", n, "z", r, 0, k) for n, r, k in [("a", 2, None), ("a", 2, "bowled"), ("b", 2, None), ("b", 2, "bowled"), ("c", 1, "bowled")]]
    got = an.combined_rank(fact(spark, balls), min_balls=1)
    assert rows(got, "batter", "combined_rank_score") == [("a", 2), ("b", 2), ("c", 6)]


def test_cards_take_player_columns(spark):
    balls = fact(spark, [("x", "a", "b", 4, 0, None)]).withColumn("batting_team", F.lit("t")).withColumn(
        "match_date", F.lit("2024-05-01").cast("date"))
    born = spark.createDataFrame([("a", "2000-05-02")], "batter string, d string").select(
        "batter", F.col("d").cast("date").alias("date_of_birth"))
    assert an.batting_card(balls, players=born).first().age == 23


def test_only_the_capped_answer_is_cut(spark):
    assert an.cap(spark.range(500), [F.asc("id")], 400).count() == 100
    assert an.top(spark.range(500), [F.asc("id")], 400).count() == 400
    assert an.top(spark.range(500), [F.desc("id")]).first().id == 499
    balls = fact(spark, [("x", f"p{i:03}", "z", 6, 0, None) for i in range(250)])
    assert an.boundaries(balls, n=None).count() == 250 and an.boundaries(balls, n=200).count() == 200
    assert an.milestone_board(balls, runs=6).count() == 250


def test_overs_of_a_phase_count_from_one(spark):
    balls = fact(spark, [("x", "a", "b", over, 0, None) for over in range(20) for _ in range(6)])
    last = an.phase_strike_rate(balls, min_balls=1).first()
    assert (last.balls, last.runs) == (30, 6 * sum(range(15, 20)))


def test_label_leaves_missing_parts_out(spark):
    row = spark.sql("SELECT an.* FROM (SELECT 'A' AS a, CAST(NULL AS STRING) AS v, DATE '2024-01-02' AS d) an")
    assert row.select(an.match_label(F.col("a"), F.lit("B"), F.col("v"), F.col("d"))).first()[0] == "A v/s B, 2024-01-02"

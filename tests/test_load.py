import json

import pytest
from conftest import rows
from matches import ALL, FIRST, people, staged, variant_of

from matchlake.operators import analytics as an
from matchlake.operators import normalise as nm
from matchlake.operators.maintain import audit
from matchlake.plans.load import STAR_RULES, load


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("star"))
    tables = load(spark, staged(spark), people(spark), folder)
    return folder, tables


def test_quarantine_keeps_whole_matches_out(star):
    _, t = star
    assert rows(t["rejected_matches"]) == [
        ("m4", ["no season"]), ("m5", ["name missing from registry"]), ("m6", ["unknown player"])]
    assert rows(t["matches"], "match_id") == [("m1",), ("m2",), ("m3",)]


def test_matches(star):
    _, t = star
    assert rows(t["matches"], "match_id", "season_year", "outcome_type", "outcome_margin") == [
        ("m1", 2007, "wickets", 4), ("m2", 2023, "tie", None), ("m3", 2019, None, None)]
    names = {r.team_id: r.team_name for r in t["teams"].collect()}
    assert sorted(names.values()) == ["Blues", "Reds"]
    m1 = t["matches"].where("match_id = 'm1'").first()
    assert (names[m1.team1_id], names[m1.team2_id], names[m1.toss_winner_team_id]) == ("Reds", "Blues", "Reds")
    assert rows(t["venues"], "venue_name", "city") == [("Oval", "Town"), ("Park", None)]


def test_people_of_a_match(star):
    _, t = star
    teams = {r.team_id: r.team_name for r in t["teams"].collect()}
    got = {(r.player_identifier, teams[r.team_id]) for r in t["match_players"].where("match_id = 'm1'").collect()}
    assert got == {("p01", "Reds"), ("p02", "Reds"), ("p03", "Reds"), ("p05", "Blues"), ("p06", "Blues")}
    assert rows(t["officials"].where("match_id = 'm1'"), "official_identifier", "match_role") == [
        ("p07", "referee"), ("p07", "umpires"), ("p08", "umpires")]
    assert rows(t["awards"].where("match_id = 'm1'")) == [("m1", "p01")]


def test_innings_and_balls(star):
    _, t = star
    innings = t["innings"].where("match_id = 'm1'")
    assert rows(innings, "inning_number", "target_runs", "target_overs", "is_super_over") == [
        (1, None, None, False), (2, 15, "20", False), (3, None, None, True)]
    first = innings.where("inning_number = 1").first().inning_id
    balls = t["deliveries"].where(f"inning_id = {first}")
    assert rows(balls, "over_number", "ball_number") == [(0, i) for i in range(1, 8)] + [(1, 1)]
    wide = balls.where("extras_wides = 1").first()
    assert json.loads(wide.raw_extras_json) == {"wides": 1} and wide.extras_byes == 0 and wide.runs_non_boundary is False
    review = balls.where("raw_review_json IS NOT NULL").first()
    assert json.loads(review.raw_review_json) == {"by": "Blues", "odd": [1, {"k": 2}]}
    assert str(t["powerplays"].where(f"inning_id = {first}").first().to_over) == "5.6"


def test_wickets_credit_and_fielders(star):
    _, t = star
    one = t["innings"].where("match_id = 'm1' AND inning_number = 1").first().inning_id
    balls = t["deliveries"].where(f"inning_id = {one}").select("delivery_id")
    wickets = t["wickets"].join(balls, "delivery_id")
    assert rows(wickets, "kind", "player_out_identifier", "bowler_credited_identifier") == [
        ("bowled", "p03", "p05"), ("caught", "p01", "p05"), ("lbw", "p03", "p05"), ("retired out", "p02", None), ("run out", "p03", None)]
    assert rows(t["wicket_fielders"].join(wickets, "wicket_id"), "fielder_player_identifier") == [("p06",)]


def test_replacements(star):
    _, t = star
    got = t["replacements"].where("match_id = 'm1'")
    assert rows(got, "replacement_type", "replaced_role", "player_in_identifier", "player_out_identifier", "reason") == [
        ("match", None, "p04", "p01", "sub"), ("role", "bowler", "p06", None, "injury")]
    assert got.where("replacement_type = 'role'").first().team_id is None


def test_constraints_hold(star):
    _, t = star
    assert rows(audit(t, STAR_RULES)) == []


def test_running_again_changes_nothing_and_keys_stay(spark, star, tmp_path):
    folder = str(tmp_path)
    few = load(spark, staged(spark, {"m2": ALL["m2"]}), people(spark), folder)
    teams, numbers = rows(few["teams"]), rows(few["match_numbers"])
    more = {**ALL, "m0": variant_of(FIRST, teams=["Aces", "Blues"], toss={}, outcome={})}
    grown = load(spark, staged(spark, more), people(spark), folder)
    assert set(teams) <= set(rows(grown["teams"])) and set(numbers) <= set(rows(grown["match_numbers"]))
    before = {name: rows(t) for name, t in grown.items() if name not in ("players",)}
    again = load(spark, staged(spark, more), people(spark), folder)
    assert {name: rows(t) for name, t in again.items() if name in before} == before
    assert again["players"].count() == 8


def test_ball_fact_equals_the_join_of_the_star_tables(star):
    _, t = star
    joined = nm.balls_from_tables(t["deliveries"], t["innings"], t["matches"], t["wickets"])
    columns = ["delivery_id", "season_year", "batter", "bowler", "runs_batter", "runs_total", "wides", "outs",
               "striker_outs", "credited_outs", "kind", "inning_number", "is_super_over"]
    assert rows(joined, *columns) == rows(t["balls"], *columns)


def test_two_wickets_on_one_ball_do_not_double_its_runs(star):
    _, t = star
    line = an.bowler_line(t["balls"].where("match_id = 'm1'"), ["p05"]).first()
    assert (line.runs_conceded, line.wickets, line.overs_bowled) == (12, 3, "1.0")


def test_super_over_is_left_out_by_default(star):
    _, t = star
    one = t["balls"].where("match_id = 'm1'")
    assert an.boundaries(one).where("batter = 'p01'").first().hits == 1
    assert an.in_play(one, super_overs=True).count() == one.count() == 13


def test_hat_trick_over_loaded_balls(star):
    _, t = star
    assert rows(an.hat_tricks(t["balls"])) == [("p05", 3)]  # one in each of the three matches


def test_keys_have_no_limits(spark, tmp_path):
    from matches import ball, out

    long_over = variant_of(FIRST)
    long_over["innings"][0]["overs"].append({"over": 2, "deliveries": [ball(runs=1) for _ in range(150)]})
    long_over["innings"][0]["overs"].append({"over": 3, "deliveries": [ball(wickets=[out("C One", "run out") for _ in range(12)])]})
    long_over["innings"] += [{"team": "Reds", "overs": [{"over": 0, "deliveries": [ball()]}]} for _ in range(120)]
    odd = variant_of(FIRST)
    odd["innings"] = [{"team": "Reds"}, {"team": None, "overs": [{"over": 0, "deliveries": [ball()]}]}, {"team": "Blues", "overs": [
        {"over": 0}, {"over": 1, "deliveries": [ball(), ball(batter=None), ball(wickets=[out("A One")])]}]}]
    t = load(spark, staged(spark, {"m1": FIRST, "long": long_over, "odd": odd}), people(spark), str(tmp_path))
    assert rows(t["rejected_matches"]) == []
    of_odd = t["innings"].where("match_id = 'odd'").select("inning_id", "inning_number")
    assert rows(of_odd, "inning_number") == [(1,), (3,)]
    assert rows(t["deliveries"].join(of_odd, "inning_id"), "inning_number", "over_number", "ball_number") == [(3, 1, 1), (3, 1, 3)]
    game = t["innings"].where("match_id = 'long'").select("inning_id")
    balls = t["deliveries"].join(game, "inning_id")
    assert balls.where("over_number = 2").count() == 150 and game.count() == 123
    many = balls.where("over_number = 3").join(t["wickets"], "delivery_id")
    assert many.count() == 12 and t["balls"].where("match_id = 'long' AND over_number = 3").first().outs == 12
    assert rows(audit(t, STAR_RULES)) == []
    # Keys are dense over all matches that were read.
    last = t["match_numbers"].selectExpr("max(before_balls + n_balls)").first()[0]
    assert last == t["match_numbers"].selectExpr("sum(n_balls)").first()[0]


def test_a_match_that_grows_gets_new_keys_and_others_keep_theirs(spark, tmp_path):
    load(spark, staged(spark, {"m1": FIRST, "m2": ALL["m2"]}), people(spark), str(tmp_path))
    ids = lambda: {m: rows(spark.read.parquet(f"{tmp_path}/balls").where(f"match_id = '{m}'"), "delivery_id", "over_number", "ball_number") for m in ("m1", "m2", "m3")}
    before = ids()
    grown = variant_of(FIRST)
    grown["innings"][1]["overs"][0]["deliveries"] *= 2
    t = load(spark, staged(spark, {"m1": grown, "m2": ALL["m2"], "m3": ALL["m3"]}), people(spark), str(tmp_path))
    after = ids()
    assert after["m2"] == before["m2"] and len(after["m1"]) == len(before["m1"]) + 3
    assert not {r[0] for r in before["m1"]} & {r[0] for r in after["m1"]}
    assert rows(audit(t, STAR_RULES)) == []
    keys = [r.delivery_id for r in t["deliveries"].collect()]
    assert len(keys) == len(set(keys))

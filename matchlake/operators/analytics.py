"""Batting, bowling, partnership and head-to-head answers over the ball fact.

The ball fact has one row per ball and carries what happened on it, so none of these needs a join with the wickets:
match_id, inning_id, inning_number, is_super_over, season_year, over_number, ball_number, batter, non_striker, bowler,
runs_batter, runs_total, wides, noballs, byes, legbyes, outs, striker_outs, credited_outs, kind (first dismissal).
Tie-break innings are left out by default. Every report has a total order, so equal runs give equal rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.fixed_values import DEFAULT_ROWS, MAX_ROWS, UNCREDITED_KINDS_NARROW
from matchlake.functions.numbers import ratio, whole_div
from matchlake.operators.ranking import null_safe_join, rank_by
from matchlake.session import cut_lineage

Players = DataFrame | Sequence | None


def in_play(balls: DataFrame, season: int | None = None, super_overs: bool = False) -> DataFrame:
    """The balls that count: no tie-breaks unless asked for, one season if given."""
    kept = balls if super_overs else balls.where(~F.col("is_super_over"))
    return kept if season is None else kept.where(F.col("season_year") == season)


def only(balls: DataFrame, column: str, players: Players) -> DataFrame:
    """Keep the balls of some players, given as values or as a table with the same column."""
    if players is None:
        return balls
    if isinstance(players, DataFrame):
        return balls.join(players.select(column), column, "left_semi")
    return balls.where(F.col(column).isin(list(players)))


def legal(rule: str = "strict") -> Column:
    """A legal ball: neither wide nor no-ball ("strict"), or only not wide ("not_wide")."""
    not_wide = F.col("wides") == 0
    return not_wide if rule == "not_wide" else not_wide & (F.col("noballs") == 0)


def _count(condition: Column) -> Column:
    return F.sum(condition.cast("long"))


def _runs(column: str = "runs_batter") -> Column:
    return F.sum(F.col(column).cast("long"))


def _as_double(num: str, den: str) -> Column:
    return F.col(num).cast("double") / F.nullif(F.col(den), F.lit(0).cast("long"))


def top(df: DataFrame, order: Sequence[Column], n: int | None = None) -> DataFrame:
    """The first ``n`` rows of a total order; all of them, in order, where no ``n`` is given."""
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(n)


def cap(df: DataFrame, order: Sequence[Column], n: int = DEFAULT_ROWS) -> DataFrame:
    """The first ``n`` rows of a total order, but never more than an answer may show; no report is cut by this."""
    return top(df, order, min(n, MAX_ROWS))


def combined_rank(balls: DataFrame, season: int | None = None, min_balls: int = 50, n: int | None = 25) -> DataFrame:
    """Batters by the sum of their strike-rate rank and their average rank.

    The balls are read once; the ranks are taken over the written batter sums.
    """
    stats = cut_lineage(
        in_play(balls, season)
        .groupBy("batter")
        .agg(_runs().alias("runs"), _count(F.col("wides") == 0).alias("faced"), F.sum("striker_outs").alias("outs"))
        .where((F.col("faced") >= min_balls) & (F.col("outs") > 0) & (F.col("faced") > 0))
        .withColumn("sr", _as_double("runs", "faced") * 100)
        .withColumn("avg", _as_double("runs", "outs"))
    )
    ranked = rank_by(rank_by(stats, "sr", "rank_sr"), "avg", "rank_avg")
    scored = ranked.select(
        "batter",
        ratio(F.col("runs"), F.col("faced"), scale=100).alias("strike_rate"),
        ratio(F.col("runs"), F.col("outs")).alias("batting_average"),
        (F.col("rank_sr") + F.col("rank_avg")).alias("combined_rank_score"),
    )
    return top(scored, [F.asc("combined_rank_score"), F.asc("batter")], n)


def boundaries(balls: DataFrame, runs: int = 6, season: int | None = None, n: int | None = DEFAULT_ROWS) -> DataFrame:
    """Most balls hit for ``runs``, with the innings in which that happened and the rate per innings."""
    counted = (
        in_play(balls, season)
        .where(F.col("runs_batter") == runs)
        .groupBy("batter")
        .agg(F.count(F.lit(1)).alias("hits"), F.count_distinct("inning_id").alias("innings_played"))
    )
    rated = counted.withColumn("hits_per_inning", ratio(F.col("hits"), F.col("innings_played")))
    return top(rated, [F.desc("hits"), F.asc("batter")], n)


def partnerships(
    balls: DataFrame, season: int | None = None, min_runs: int = 300, n: int | None = DEFAULT_ROWS, credited_only: bool = True
) -> DataFrame:
    """Pairs of batters together: runs, run rate, each one's share, boundaries and average, best run rate first."""
    first = F.least("batter", "non_striker")
    second = F.greatest("batter", "non_striker")
    pairs = (
        in_play(balls, season)
        .groupBy(first.alias("player1"), second.alias("player2"))
        .agg(
            _runs().alias("partnership_runs"),
            F.sum(F.when(F.col("batter") == first, F.col("runs_batter")).otherwise(0)).alias("p1"),
            F.sum(F.when(F.col("batter") == second, F.col("runs_batter")).otherwise(0)).alias("p2"),
            _count(legal()).alias("balls"),
            _count(F.col("runs_batter").isin(4, 6)).alias("fours_sixes"),
            F.sum("credited_outs" if credited_only else "outs").alias("broken"),
            F.count_distinct("inning_id").alias("innings_played"),
        )
        .where(F.col("partnership_runs") >= min_runs)
    )

    def share(part: str) -> Column:
        percent = ratio(F.col(part), F.col("partnership_runs"), digits=0, scale=100).cast("long").cast("string")
        return F.concat(F.col(part).cast("string"), F.lit(" ("), percent, F.lit("%)"))

    shown = pairs.select(
        "player1",
        "player2",
        "partnership_runs",
        "innings_played",
        ratio(F.col("partnership_runs"), F.col("balls"), scale=6).alias("run_rate"),
        F.concat(share("p1"), F.lit(" vs "), share("p2")).alias("contribution"),
        ratio(F.col("fours_sixes"), F.col("innings_played")).alias("boundaries_per_inning"),
        ratio(F.col("partnership_runs"), F.col("broken")).alias("partnership_average"),
    )
    return top(shown, [F.desc_nulls_last("run_rate"), F.asc("player1"), F.asc("player2")], n)


def hat_tricks(balls: DataFrame, length: int = 3, n: int | None = DEFAULT_ROWS, super_overs: bool = True) -> DataFrame:
    """Bowlers by runs of ``length`` credited wickets on consecutive balls of theirs within one innings.

    One window over a bowler's balls in an innings, a group that the rules of the game keep small: a ball ends a
    hat-trick if it and the ``length - 1`` balls before it all took a credited wicket.
    """
    last = Window.partitionBy("inning_id", "bowler").orderBy("over_number", "ball_number").rowsBetween(1 - length, 0)
    took = in_play(balls, super_overs=super_overs).select(
        "inning_id", "bowler", "over_number", "ball_number", (F.col("credited_outs") > 0).cast("int").alias("took")
    )
    done = took.select("bowler", F.sum("took").over(last).alias("in_a_row")).where(F.col("in_a_row") == length)
    counted = done.groupBy("bowler").agg(F.count(F.lit(1)).alias("hat_tricks"))
    return top(counted, [F.desc("hat_tricks"), F.asc("bowler")], n)


def bowler_line(
    balls: DataFrame, bowlers: Players = None, season: int | None = None, rule: str = "strict",
    credited_only: bool = True,
) -> DataFrame:
    """Runs conceded, wickets, overs as ``n.m`` and economy of each bowler."""
    lines = (
        only(in_play(balls, season), "bowler", bowlers)
        .groupBy("bowler")
        .agg(
            F.count_distinct("match_id").alias("matches_played"),
            F.sum((F.col("runs_batter") + F.col("wides") + F.col("noballs")).cast("long")).alias("runs_conceded"),
            F.sum("credited_outs" if credited_only else "outs").alias("wickets"),
            _count(legal(rule)).alias("legal_balls"),
        )
    )
    overs = F.concat_ws(
        ".", whole_div(F.col("legal_balls"), F.lit(6)).cast("string"), (F.col("legal_balls") % 6).cast("string")
    )
    return lines.select(
        "bowler", "matches_played", "runs_conceded", "wickets", overs.alias("overs_bowled"),
        ratio(F.col("runs_conceded"), F.col("legal_balls"), scale=6).alias("economy_rate"),
    )


def innings_scores(balls: DataFrame) -> DataFrame:
    """Runs of each batter in each innings."""
    return in_play(balls).groupBy("batter", "inning_id").agg(_runs().alias("runs"))


def milestones(balls: DataFrame, batters: Players = None, runs: int = 100) -> DataFrame:
    """Innings of at least ``runs``, innings played and best score of each batter."""
    scores = innings_scores(only(balls, "batter", batters))
    return scores.groupBy("batter").agg(
        _count(F.col("runs") >= runs).alias("milestones"),
        F.count(F.lit(1)).alias("innings_played"),
        F.max("runs").alias("highest_score"),
    )


def milestone_board(balls: DataFrame, runs: int = 100, n: int | None = None) -> DataFrame:
    """The batters by innings of at least ``runs``, all who have one."""
    board = milestones(balls, None, runs).where(F.col("milestones") > 0)
    return top(board, [F.desc("milestones"), F.desc("highest_score"), F.asc("batter")], n)


def _first_innings_totals(balls: DataFrame, *keep: str) -> DataFrame:
    return (
        in_play(balls)
        .where(F.col("inning_number") == 1)
        .groupBy("match_id", "inning_id", *keep)
        .agg(_runs("runs_total").alias("total"))
    )


def first_innings_avg(balls: DataFrame, n: int | None = None) -> DataFrame:
    """Average first-innings total of each season."""
    by_season = _first_innings_totals(balls, "season_year").groupBy("season_year").agg(
        F.sum("total").alias("runs"), F.count(F.lit(1)).alias("innings")
    )
    shown = by_season.select("season_year", ratio(F.col("runs"), F.col("innings")).alias("average_score"))
    return top(shown, [F.desc_nulls_last("season_year")], n)


def venue_avg(balls: DataFrame, venues: DataFrame, min_matches: int = 5, n: int | None = DEFAULT_ROWS) -> DataFrame:
    """Venues by average first-innings total; ``venues`` gives match_id and venue."""
    totals = _first_innings_totals(balls).join(venues.select("match_id", "venue"), "match_id")
    by_venue = (
        totals.groupBy("venue")
        .agg(F.sum("total").alias("runs"), F.count(F.lit(1)).alias("matches_played"))
        .where(F.col("matches_played") >= min_matches)
    )
    shown = by_venue.select(
        "venue", "matches_played", ratio(F.col("runs"), F.col("matches_played")).alias("average_score")
    )
    return top(shown, [F.desc("average_score"), F.asc("venue")], n)


def head_to_head(
    balls: DataFrame, bowlers: Players = None, min_balls: int = 30, n: int | None = DEFAULT_ROWS,
    count_wides: bool = True, super_overs: bool = True, credited_only: bool = True,
) -> DataFrame:
    """Batter against bowler: runs, balls, dismissals, rates, boundaries, dot share and usual dismissal.

    The sums are first taken per kind of dismissal, so that the usual one falls out of the same aggregation.
    """
    faced = only(in_play(balls, super_overs=super_overs), "bowler", bowlers)
    if not count_wides:
        faced = faced.where(F.col("wides") == 0)
    out = F.col("credited_outs" if credited_only else "outs")
    parts = faced.groupBy("bowler", "batter", F.when(out > 0, F.col("kind")).alias("kind")).agg(
        _runs().alias("runs"), F.count(F.lit(1)).alias("balls"), F.sum(out).alias("outs"),
        _count(F.col("runs_batter") == 4).alias("fours"), _count(F.col("runs_batter") == 6).alias("sixes"),
        _count(F.col("runs_batter") == 0).alias("dots"),
    )
    usual = F.min(F.when(F.col("kind").isNotNull(), F.struct((-F.col("outs")).alias("less"), F.col("kind"))))
    totals = (
        parts.groupBy("bowler", "batter")
        .agg(*[F.sum(c).alias(c) for c in ["runs", "balls", "outs", "fours", "sixes", "dots"]], usual.alias("usual"))
        .where(F.col("balls") >= min_balls)
    )
    shown = totals.select(
        "bowler", "batter", "runs", "balls", "outs",
        ratio(F.col("runs"), F.col("balls"), scale=100).alias("strike_rate"),
        ratio(F.col("runs"), F.col("outs")).alias("batting_average"),
        "fours", "sixes",
        ratio(F.col("dots"), F.col("balls"), scale=100).alias("dot_ball_pct"),
        F.col("usual.kind").alias("common_dismissal"),
    )
    return top(shown, [F.desc("strike_rate"), F.asc("bowler"), F.asc("batter")], n)


def ball_flags(balls: DataFrame) -> DataFrame:
    """What each ball means for the bowler: a wicket of theirs, a ball of the over, a dot."""
    wicket = F.col("kind").isNotNull() & ~F.col("kind").isin(UNCREDITED_KINDS_NARROW)
    extras = F.col("wides") + F.col("noballs") + F.col("byes") + F.col("legbyes")
    return balls.select(
        "match_id", "bowler", "batter", "runs_batter", "wides", "noballs", "runs_total",
        F.coalesce(wicket, F.lit(False)).cast("int").alias("is_bowler_wicket"),
        (F.col("wides") == 0).cast("int").alias("counts_to_over"),
        ((F.col("runs_batter") == 0) & (extras == 0)).cast("int").alias("is_dot"),
    )


def top_bowlers(balls: DataFrame, n: int | None = 25) -> DataFrame:
    """Bowlers by wickets, then strike rate, average, economy and dot balls."""
    sums = (
        ball_flags(balls)
        .groupBy("bowler")
        .agg(
            F.sum("is_bowler_wicket").alias("wickets"),
            F.sum((F.col("runs_batter") + F.col("wides") + F.col("noballs")).cast("long")).alias("runs_conceded"),
            F.sum("counts_to_over").alias("balls_bowled"),
            F.sum("is_dot").alias("dot_balls"),
        )
        .where(F.col("balls_bowled") > 0)
    )
    rated = sums.select(
        "*",
        ratio(F.col("runs_conceded"), F.col("balls_bowled"), 4, 6).alias("economy_rate"),
        ratio(F.col("balls_bowled"), F.col("wickets"), 4).alias("bowling_strike_rate"),
        ratio(F.col("runs_conceded"), F.col("wickets"), 4).alias("bowling_average"),
    )
    order = [
        F.desc("wickets"), F.asc_nulls_last("bowling_strike_rate"), F.asc_nulls_last("bowling_average"),
        F.asc_nulls_last("economy_rate"), F.desc("dot_balls"), F.asc("bowler"),
    ]
    return top(rated, order, n)


def vs_bowlers(
    balls: DataFrame, bowlers: DataFrame, awards: DataFrame, min_bowlers: int = 10, min_balls: int = 200, n: int = 25
) -> DataFrame:
    """Batters against a chosen set of bowlers, with their awards (batter, awards)."""
    faced = (
        only(balls, "bowler", bowlers)
        .groupBy("batter")
        .agg(
            _runs().alias("runs"), _count(F.col("wides") == 0).alias("balls"),
            _count(F.col("runs_batter") == 4).alias("fours"), _count(F.col("runs_batter") == 6).alias("sixes"),
            F.sum("striker_outs").alias("outs"), F.count_distinct("bowler").alias("bowlers_faced"),
        )
        .where((F.col("bowlers_faced") >= min_bowlers) & (F.col("balls") >= min_balls))
    )
    shown = faced.join(awards, "batter", "left").select(
        "batter", "runs", "balls",
        ratio(F.col("runs"), F.col("balls"), scale=100).alias("strike_rate"),
        ratio(F.col("runs"), F.col("outs")).alias("batting_average"),
        (F.col("fours") + F.col("sixes")).alias("boundaries"), "fours", "sixes", "outs", "bowlers_faced",
        F.coalesce("awards", F.lit(0).cast("long")).alias("awards"),
    )
    order = [
        F.desc("runs"), F.desc_nulls_last("strike_rate"), F.desc_nulls_last("batting_average"), F.desc("boundaries"),
        F.desc("awards"), F.asc("batter"),
    ]
    return top(shown, order, n)


def award_counts(awards: DataFrame, player: str = "player_identifier") -> DataFrame:
    """Awards per player."""
    return awards.groupBy(player).agg(F.count(F.lit(1)).alias("awards"))


def compare(balls: DataFrame, batters: Players) -> DataFrame:
    """Career runs and average of some batters side by side."""
    sums = only(in_play(balls), "batter", batters).groupBy("batter").agg(
        _runs().alias("runs"), F.sum("striker_outs").alias("outs"), F.count_distinct("inning_id").alias("innings")
    )
    return sums.withColumn("batting_average", ratio(F.col("runs"), F.col("outs")))


def phase_strike_rate(
    balls: DataFrame, overs: tuple[int, int] = (16, 20), season: int | None = None, min_balls: int = 50,
    n: int | None = DEFAULT_ROWS,
) -> DataFrame:
    """Best strike rates in a range of overs, counted from 1 as people do; the fact counts them from 0."""
    sums = (
        in_play(balls, season)
        .where(F.col("over_number").between(overs[0] - 1, overs[1] - 1))
        .groupBy("batter")
        .agg(_runs().alias("runs"), _count(F.col("wides") == 0).alias("balls"))
        .where(F.col("balls") >= min_balls)
    )
    shown = sums.withColumn("strike_rate", ratio(F.col("runs"), F.col("balls"), scale=100))
    return top(shown, [F.desc_nulls_last("strike_rate"), F.asc("batter")], n)


def boundaries_per_match(balls: DataFrame, season: int | None = None) -> DataFrame:
    """Fours and sixes per match of each season.

    One row per match first, so the distinct count needs no expansion of the balls.
    """
    per_match = in_play(balls, season).groupBy("season_year", "match_id").agg(
        _count(F.col("runs_batter").isin(4, 6)).alias("hits")
    )
    seasons = per_match.groupBy("season_year").agg(
        F.sum("hits").alias("boundaries"), F.count(F.lit(1)).alias("matches_played")
    )
    return seasons.withColumn("per_match", ratio(F.col("boundaries"), F.col("matches_played")))


def age_on(born: Column, day: Column) -> Column:
    """Completed years; NULL where the birth date is unknown."""
    return F.floor(F.months_between(day, born) / 12).cast("int")


def batting_card(balls: DataFrame, by: str = "batting_team", players: DataFrame | None = None) -> DataFrame:
    """Matches, runs, balls, outs, rates and share of the team's runs of each batter, per ``by``.

    Team totals are a second small aggregation joined back, not a window over all batters of a team. ``players``
    (batter, date_of_birth, ...) adds its columns and the age at the batter's last match.
    """
    dates = [F.max("match_date").alias("last_match")] if players is not None else []
    sums = in_play(balls).groupBy(by, "batter").agg(
        F.count_distinct("match_id").alias("matches_played"), _runs().alias("runs"),
        _count(F.col("wides") == 0).alias("balls"), F.sum("striker_outs").alias("outs"),
        _count(F.col("runs_batter") == 4).alias("fours"), _count(F.col("runs_batter") == 6).alias("sixes"), *dates,
    )
    teams = sums.groupBy(by).agg(F.sum("runs").alias("team_runs"))
    card = null_safe_join(sums, teams, [by]).select(
        by, "batter", "matches_played", "runs", "balls", "outs",
        ratio(F.col("runs"), F.col("outs")).alias("batting_average"),
        ratio(F.col("runs"), F.col("balls"), scale=100).alias("strike_rate"), "fours", "sixes",
        ratio(F.col("runs"), F.col("team_runs"), scale=100).alias("team_share_pct"),
        *(["last_match"] if players is not None else []),
    )
    if players is None:
        return card
    return card.join(players, "batter", "left").withColumn("age", age_on(F.col("date_of_birth"), F.col("last_match")))


def bowling_card(balls: DataFrame, by: str | None = None, players: DataFrame | None = None) -> DataFrame:
    """Matches, balls, runs, wickets, average, strike rate and economy of each bowler, per ``by`` if given."""
    keys = [by, "bowler"] if by else ["bowler"]
    sums = in_play(balls).groupBy(*keys).agg(
        F.count_distinct("match_id").alias("matches_played"), _count(legal()).alias("balls"),
        F.sum((F.col("runs_batter") + F.col("wides") + F.col("noballs")).cast("long")).alias("runs_conceded"),
        F.sum("credited_outs").alias("wickets"),
    )
    card = sums.select(
        *keys, "matches_played", "balls", "runs_conceded", "wickets",
        ratio(F.col("runs_conceded"), F.col("wickets")).alias("bowling_average"),
        ratio(F.col("balls"), F.col("wickets")).alias("bowling_strike_rate"),
        ratio(F.col("runs_conceded"), F.col("balls"), scale=6).alias("economy_rate"),
    )
    return card if players is None else card.join(players, "bowler", "left")


def fielding_card(catches: DataFrame, fielder: str = "fielder", kind: str = "kind") -> DataFrame:
    """Catches, stumpings and run outs of each fielder, from rows of (match_id, fielder, kind)."""
    return catches.groupBy(fielder).agg(
        F.count_distinct("match_id").alias("matches_played"),
        _count(F.col(kind).isin("caught", "caught and bowled")).alias("catches"),
        _count(F.col(kind) == "stumped").alias("stumpings"),
        _count(F.col(kind) == "run out").alias("run_outs"),
    )


def toss_wins(matches: DataFrame, by: str, won: Column) -> DataFrame:
    """Tosses won, matches and percentage per ``by``."""
    sums = matches.groupBy(by).agg(
        F.sum(F.coalesce(won, F.lit(False)).cast("long")).alias("toss_wins"),
        F.count(F.lit(1)).alias("matches_played"),
    )
    return sums.withColumn("toss_win_pct", ratio(F.col("toss_wins"), F.col("matches_played"), scale=100))


def match_label(team1: Column, team2: Column, venue: Column, day: Column) -> Column:
    """Readable match name; missing parts are left out instead of making the whole NULL."""
    return F.concat_ws(
        ", ", F.concat_ws(" v/s ", team1, team2), venue, F.date_format(day, "yyyy-MM-dd")
    )


def with_labels(df: DataFrame, labels: DataFrame, key: str, name: str, out: str) -> DataFrame:
    """Replace an internal id by the readable name that ``labels`` (key, name) gives for it."""
    named = labels.select(F.col(key), F.col(name).alias(out))
    return df.join(named, key, "left").drop(key)

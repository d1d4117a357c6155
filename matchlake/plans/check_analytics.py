"""Analytical queries over the ball view of the line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake.operators import analytics as an
from matchlake.plans.checks import check
from matchlake.plans.tables import BALL_VIEWS, Tables, sql_ratio


@check("an_combined_rank", BALL_VIEWS + f""",
stats AS (
  SELECT batter, sum(runs_batter) AS runs, count(*) FILTER (wides = 0) AS faced,
         count(*) FILTER (player_out = batter) AS outs
  FROM balls WHERE NOT is_super_over AND season_year = 1998 GROUP BY batter
  HAVING count(*) FILTER (wides = 0) >= 50),
ranked AS (
  SELECT *, rank() OVER (ORDER BY CAST(runs AS DOUBLE) / faced * 100 DESC) AS a,
         rank() OVER (ORDER BY CAST(runs AS DOUBLE) / outs DESC) AS b
  FROM stats WHERE outs > 0)
SELECT batter, {sql_ratio('runs', 'faced', scale=100)} AS strike_rate,
       {sql_ratio('runs', 'outs')} AS batting_average, CAST(a + b AS BIGINT) AS combined_rank_score
FROM ranked ORDER BY combined_rank_score, batter LIMIT 25""")
def _(t: Tables):
    return an.combined_rank(t.season_balls, season=1998, min_balls=50, n=25)


@check("an_boundary_count", BALL_VIEWS + f"""
SELECT batter, count(*) AS hits, count(DISTINCT inning_id) AS innings_played,
       {sql_ratio('count(*)', 'count(DISTINCT inning_id)')} AS hits_per_inning
FROM balls WHERE runs_batter = 6 AND NOT is_super_over
GROUP BY batter ORDER BY hits DESC, batter LIMIT 10""")
def _(t: Tables):
    return an.boundaries(t.balls)


@check("an_partnership", BALL_VIEWS + f""",
pairs AS (
  SELECT least(batter, non_striker) AS player1, greatest(batter, non_striker) AS player2,
         CAST(sum(runs_batter) AS BIGINT) AS r, CAST(sum(CASE WHEN batter < non_striker THEN runs_batter ELSE 0 END) AS BIGINT) AS r1,
         CAST(sum(CASE WHEN batter > non_striker THEN runs_batter ELSE 0 END) AS BIGINT) AS r2,
         count(*) FILTER (wides = 0 AND noballs = 0) AS b, count(*) FILTER (runs_batter IN (4, 6)) AS f,
         count(credited) AS o, count(DISTINCT inning_id) AS i
  FROM balls WHERE NOT is_super_over GROUP BY 1, 2 HAVING sum(runs_batter) >= 100)
SELECT player1, player2, r AS partnership_runs, i AS innings_played,
       {sql_ratio('r', 'b', scale=6)} AS run_rate,
       r1 || ' (' || CAST((r1 * 200 + r) // (2 * r) AS BIGINT) || '%) vs ' || r2 || ' ('
         || CAST((r2 * 200 + r) // (2 * r) AS BIGINT) || '%)' AS contribution,
       {sql_ratio('f', 'i')} AS boundaries_per_inning, {sql_ratio('r', 'o')} AS partnership_average
FROM pairs ORDER BY run_rate DESC NULLS LAST, player1, player2 LIMIT 100""")
def _(t: Tables):
    return an.partnerships(t.balls, min_runs=100, n=100)


@check("an_hat_trick", BALL_VIEWS + """,
numbered AS (
  SELECT bowler, inning_id, credited, row_number() OVER (PARTITION BY inning_id, bowler ORDER BY ball_seq) AS n
  FROM balls),
hits AS (
  SELECT bowler, n, lag(n, 1) OVER w AS p, lag(n, 2) OVER w AS q FROM numbered WHERE credited IS NOT NULL
  WINDOW w AS (PARTITION BY inning_id, bowler ORDER BY n))
SELECT bowler, count(*) AS hat_tricks FROM hits WHERE n = p + 1 AND p = q + 1
GROUP BY bowler ORDER BY hat_tricks DESC, bowler LIMIT 10""")
def _(t: Tables):
    return an.hat_tricks(t.balls)


@check("an_runs_conceded", BALL_VIEWS + f""",
lines AS (
  SELECT bowler, count(DISTINCT match_id) AS m, sum(runs_batter + wides + noballs) AS r, count(credited) AS w,
         count(*) FILTER (wides = 0 AND noballs = 0) AS b
  FROM balls WHERE NOT is_super_over GROUP BY bowler)
SELECT bowler, m AS matches_played, CAST(r AS BIGINT) AS runs_conceded, w AS wickets,
       (b // 6) || '.' || (b % 6) AS overs_bowled, {sql_ratio('r', 'b', scale=6)} AS economy_rate
FROM lines""")
def _(t: Tables):
    return an.bowler_line(t.balls)


@check("an_centuries", BALL_VIEWS + """,
scores AS (
  SELECT batter, inning_id, sum(runs_batter) AS runs FROM balls WHERE NOT is_super_over GROUP BY ALL)
SELECT batter, count(*) FILTER (runs >= 9) AS milestones, count(*) AS innings_played,
       CAST(max(runs) AS BIGINT) AS highest_score
FROM scores GROUP BY batter""")
def _(t: Tables):
    return an.milestones(t.balls, runs=9)


@check("an_first_innings_avg", BALL_VIEWS + f""",
totals AS (
  SELECT season_year, inning_id, sum(runs_batter + wides + noballs) AS total FROM balls
  WHERE inning_number = 1 AND NOT is_super_over GROUP BY ALL)
SELECT CAST(season_year AS INTEGER) AS season_year, {sql_ratio('sum(total)', 'count(*)')} AS average_score FROM totals GROUP BY season_year""")
def _(t: Tables):
    return an.first_innings_avg(t.season_balls)


@check("an_head_to_head", BALL_VIEWS + f""",
pairs AS (
  SELECT bowler, batter, sum(runs_batter) AS r, count(*) AS b, count(credited) AS o,
         count(*) FILTER (runs_batter = 4) AS fours, count(*) FILTER (runs_batter = 6) AS sixes,
         count(*) FILTER (runs_batter = 0) AS dots
  FROM balls GROUP BY ALL HAVING count(*) >= 30),
kinds AS (
  SELECT bowler, batter, kind, row_number() OVER (PARTITION BY bowler, batter ORDER BY count(*) DESC, kind) AS place
  FROM balls WHERE credited IS NOT NULL GROUP BY bowler, batter, kind)
SELECT p.bowler, p.batter, CAST(r AS BIGINT) AS runs, b AS balls, o AS outs,
       {sql_ratio('r', 'b', scale=100)} AS strike_rate, {sql_ratio('r', 'o')} AS batting_average,
       fours, sixes, {sql_ratio('dots', 'b', scale=100)} AS dot_ball_pct, k.kind AS common_dismissal
FROM pairs p LEFT JOIN kinds k ON k.bowler = p.bowler AND k.batter = p.batter AND k.place = 1
ORDER BY strike_rate DESC, p.bowler, p.batter LIMIT 100""")
def _(t: Tables):
    return an.head_to_head(t.balls, min_balls=30, n=100)


TOP_BOWLERS_SQL = f"""
SELECT bowler, count(*) FILTER (kind <> 'run out') AS wickets,
       CAST(sum(runs_batter + wides + noballs) AS BIGINT) AS runs_conceded, count(*) FILTER (wides = 0) AS balls_bowled,
       count(*) FILTER (runs_batter = 0 AND wides = 0 AND noballs = 0) AS dot_balls,
       {sql_ratio('sum(runs_batter + wides + noballs)', 'count(*) FILTER (wides = 0)', 4, 6)} AS economy_rate,
       {sql_ratio('count(*) FILTER (wides = 0)', "count(*) FILTER (kind <> 'run out')", 4)} AS bowling_strike_rate,
       {sql_ratio('sum(runs_batter + wides + noballs)', "count(*) FILTER (kind <> 'run out')", 4)} AS bowling_average
FROM balls GROUP BY bowler HAVING count(*) FILTER (wides = 0) > 0
ORDER BY wickets DESC, bowling_strike_rate NULLS LAST, bowling_average NULLS LAST, economy_rate NULLS LAST,
         dot_balls DESC, bowler LIMIT"""


@check("an_top_bowlers", BALL_VIEWS + TOP_BOWLERS_SQL + " 15")
def _(t: Tables):
    return an.top_bowlers(t.balls, n=15)


@check("an_vs_top_bowlers", BALL_VIEWS + f""",
best AS ({TOP_BOWLERS_SQL} 15),
awards AS (SELECT o_custkey % 40 AS batter, count(*) AS awards FROM orders GROUP BY 1),
sums AS (
  SELECT batter, sum(runs_batter) AS r, count(*) FILTER (wides = 0) AS b, count(*) FILTER (runs_batter = 4) AS f4,
         count(*) FILTER (runs_batter = 6) AS f6, count(*) FILTER (player_out = batter) AS o,
         count(DISTINCT bowler) AS faced
  FROM balls WHERE bowler IN (SELECT bowler FROM best) GROUP BY batter)
SELECT batter, CAST(r AS BIGINT) AS runs, b AS balls, {sql_ratio('r', 'b', scale=100)} AS strike_rate,
       {sql_ratio('r', 'o')} AS batting_average, f4 + f6 AS boundaries, f4 AS fours, f6 AS sixes, o AS outs,
       faced AS bowlers_faced, coalesce(awards, 0) AS awards
FROM sums LEFT JOIN awards USING (batter) WHERE faced >= 10 AND b >= 200
ORDER BY runs DESC, strike_rate DESC NULLS LAST, batting_average DESC NULLS LAST, boundaries DESC, awards DESC, batter
LIMIT 25""")
def _(t: Tables):
    awards = an.award_counts(t.orders.select((F.col("o_custkey") % 40).alias("batter")), "batter")
    return an.vs_bowlers(t.balls, an.top_bowlers(t.balls, n=15), awards)


@check("an_bowler_ball_flags", BALL_VIEWS + """
SELECT match_id, bowler, batter, runs_batter, wides, noballs, runs_batter + wides + noballs AS runs_total,
       CAST(coalesce(kind <> 'run out', false) AS INTEGER) AS is_bowler_wicket,
       CAST(wides = 0 AS INTEGER) AS counts_to_over,
       CAST(runs_batter = 0 AND wides = 0 AND noballs = 0 AS INTEGER) AS is_dot
FROM balls""")
def _(t: Tables):
    return an.ball_flags(t.balls)


@check("an_award_counts", "SELECT o_orderpriority AS award, count(*) AS awards FROM orders GROUP BY 1")
def _(t: Tables):
    return an.award_counts(t.matches, "award")


@check("an_player_compare", BALL_VIEWS + f"""
SELECT batter, CAST(sum(runs_batter) AS BIGINT) AS runs, count(*) FILTER (player_out = batter) AS outs,
       count(DISTINCT inning_id) AS innings,
       {sql_ratio('sum(runs_batter)', 'count(*) FILTER (player_out = batter)')} AS batting_average
FROM balls WHERE batter IN (7, 18) AND NOT is_super_over GROUP BY batter""")
def _(t: Tables):
    return an.compare(t.balls, [7, 18])


@check("an_phase_strike_rate", BALL_VIEWS + f"""
SELECT batter, CAST(sum(runs_batter) AS BIGINT) AS runs, count(*) FILTER (wides = 0) AS balls,
       {sql_ratio('sum(runs_batter)', 'count(*) FILTER (wides = 0)', scale=100)} AS strike_rate
FROM balls WHERE over_number BETWEEN 4 AND 7 AND season_year = 1998 AND NOT is_super_over
GROUP BY batter HAVING count(*) FILTER (wides = 0) >= 20
ORDER BY strike_rate DESC, batter LIMIT 10""")
def _(t: Tables):
    return an.phase_strike_rate(t.season_balls, (5, 8), season=1998, min_balls=20)


@check("an_venue_avg", BALL_VIEWS + f""",
totals AS (
  SELECT match_id, inning_id, host, sum(runs_batter + wides + noballs) AS total FROM balls
  WHERE inning_number = 1 AND NOT is_super_over GROUP BY ALL)
SELECT n_name AS venue, count(*) AS matches_played, {sql_ratio('sum(total)', 'count(*)')} AS average_score
FROM totals JOIN customer ON c_custkey = host JOIN nation ON n_nationkey = c_nationkey
GROUP BY n_name HAVING count(*) >= 5 ORDER BY average_score DESC, venue LIMIT 10""")
def _(t: Tables):
    return an.venue_avg(t.balls, t.match_venues)


@check("an_century_leaderboard", BALL_VIEWS + """,
scores AS (
  SELECT batter, inning_id, sum(runs_batter) AS runs FROM balls WHERE NOT is_super_over GROUP BY ALL)
SELECT batter, count(*) FILTER (runs >= 9) AS milestones, count(*) AS innings_played,
       CAST(max(runs) AS BIGINT) AS highest_score
FROM scores GROUP BY batter HAVING count(*) FILTER (runs >= 9) > 0""")
def _(t: Tables):
    return an.milestone_board(t.balls, runs=9)


@check("an_boundaries_per_match", BALL_VIEWS + f"""
SELECT CAST(season_year AS INTEGER) AS season_year, count(*) FILTER (runs_batter IN (4, 6)) AS boundaries,
       count(DISTINCT match_id) AS matches_played,
       {sql_ratio('count(*) FILTER (runs_batter IN (4, 6))', 'count(DISTINCT match_id)')} AS per_match
FROM balls WHERE NOT is_super_over GROUP BY season_year""")
def _(t: Tables):
    return an.boundaries_per_match(t.season_balls)


@check("an_batting_card", BALL_VIEWS + f""",
sums AS (
  SELECT batting_team, batter, count(DISTINCT match_id) AS m, sum(runs_batter) AS r,
         count(*) FILTER (wides = 0) AS b, count(*) FILTER (player_out = batter) AS o,
         count(*) FILTER (runs_batter = 4) AS f4, count(*) FILTER (runs_batter = 6) AS f6
  FROM balls WHERE NOT is_super_over GROUP BY ALL),
shares AS (SELECT *, sum(r) OVER (PARTITION BY batting_team) AS team FROM sums)
SELECT batting_team, batter, m AS matches_played, CAST(r AS BIGINT) AS runs, b AS balls, o AS outs,
       {sql_ratio('r', 'o')} AS batting_average, {sql_ratio('r', 'b', scale=100)} AS strike_rate,
       f4 AS fours, f6 AS sixes, {sql_ratio('r', 'team', scale=100)} AS team_share_pct
FROM shares""")
def _(t: Tables):
    return an.batting_card(t.season_balls)


@check("an_bowling_card", BALL_VIEWS + f""",
sums AS (
  SELECT season_year, bowler, count(DISTINCT match_id) AS m, count(*) FILTER (wides = 0 AND noballs = 0) AS b,
         sum(runs_batter + wides + noballs) AS r, count(credited) AS w
  FROM balls WHERE NOT is_super_over GROUP BY ALL)
SELECT CAST(season_year AS INTEGER) AS season_year, bowler, m AS matches_played, b AS balls,
       CAST(r AS BIGINT) AS runs_conceded, w AS wickets, {sql_ratio('r', 'w')} AS bowling_average,
       {sql_ratio('b', 'w')} AS bowling_strike_rate, {sql_ratio('r', 'b', scale=6)} AS economy_rate
FROM sums""")
def _(t: Tables):
    return an.bowling_card(t.season_balls, by="season_year")


@check("an_fielding_card", """
SELECT l_suppkey AS fielder, count(DISTINCT l_orderkey) AS matches_played,
       count(*) FILTER (l_returnflag = 'R') AS catches, count(*) FILTER (l_returnflag = 'A') AS stumpings,
       count(*) FILTER (l_returnflag = 'N') AS run_outs
FROM lineitem GROUP BY 1""")
def _(t: Tables):
    kind = F.when(F.col("l_returnflag") == "R", "caught").when(F.col("l_returnflag") == "A", "stumped").otherwise("run out")
    return an.fielding_card(
        t.lineitem.select(F.col("l_orderkey").alias("match_id"), F.col("l_suppkey").alias("fielder"), kind.alias("kind"))
    )


@check("an_toss_wins", f"""
SELECT n_name AS venue, count(*) FILTER (o_orderstatus = 'F') AS toss_wins, count(*) AS matches_played,
       {sql_ratio("count(*) FILTER (o_orderstatus = 'F')", 'count(*)', scale=100)} AS toss_win_pct
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""")
def _(t: Tables):
    return an.toss_wins(t.match_venues, "venue", F.col("toss") == "F")


@check("an_match_label", """
SELECT o_orderkey, c_name || ' v/s ' || r_name || ', ' || n_name || ', ' || strftime(o_orderdate, '%Y-%m-%d') AS label
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey""")
def _(t: Tables):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    homes = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    label = an.match_label(F.col("c_name"), F.col("r_name"), F.col("n_name"), F.col("o_orderdate"))
    labels = t.orders.join(homes, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", label.alias("label"))
    return an.with_labels(
        t.orders.select("o_orderkey", F.col("o_orderkey").alias("match_id")),
        labels.withColumnRenamed("o_orderkey", "match_id"), "match_id", "label", "label",
    )


@check("an_capped_result", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def _(t: Tables):
    return an.cap(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 250)

"""Normalisation of nested match documents, made of the text table."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake.functions.matches import outcome_cols, season_col
from matchlake.operators import analytics as an
from matchlake.operators import normalise as nm
from matchlake.operators.maintain import KEY_RANGES
from matchlake.plans.checks import check
from matchlake.plans.tables import Tables
from matchlake.plans.text_matches import TEXT_VIEWS, document_text
from matchlake.sources.documents import number_matches, parse_documents, with_key_counts


@check("norm_teams", TEXT_VIEWS + "SELECT team_name FROM team_names")
def _(t: Tables):
    return nm.teams(t.good_docs)


@check("norm_venues", TEXT_VIEWS + "SELECT venue_name, city, venue_id FROM venues")
def _(t: Tables):
    return t.venues


_SEASON = """CAST(CASE n_chars % 3 WHEN 0 THEN 2000 + n_chars % 20 WHEN 1 THEN 2007
  ELSE year(DATE '2001-01-01' + CAST(doc_id % 9000 AS INTEGER)) END AS INTEGER)"""
_OUTCOME = "CASE n_chars % 4 WHEN 0 THEN 'wickets' WHEN 1 THEN 'runs' WHEN 2 THEN 'tie' END"
_MARGIN = "CAST(CASE n_chars % 4 WHEN 0 THEN 5 WHEN 1 THEN n_chars % 50 END AS INTEGER)"


@check("norm_matches", TEXT_VIEWS + f"""
SELECT CAST(doc_id AS VARCHAR) AS match_id, {_SEASON} AS season_year,
       DATE '2001-01-01' + CAST(doc_id % 9000 AS INTEGER) AS match_date, source AS event_name,
       CAST(n_chars AS INTEGER) AS match_number, venue_id, h.team_id AS team1_id, a.team_id AS team2_id,
       h.team_id AS toss_winner_team_id, CASE n_chars % 2 WHEN 0 THEN 'bat' ELSE 'field' END AS toss_decision,
       CASE WHEN n_chars % 4 <> 2 THEN a.team_id END AS outcome_winner_team_id, {_OUTCOME} AS outcome_type,
       {_MARGIN} AS outcome_margin, 'T20' AS match_type, 20 AS overs_limit, 6 AS balls_per_over
FROM good JOIN venues ON venue_name = source || ' ground' JOIN teams h ON h.team_name = 'Home ' || lang
JOIN teams a ON a.team_name = 'Away ' || source""")
def _(t: Tables):
    return nm.matches(t.stored_docs, t.teams, t.venues)


@check("parse_season", f"SELECT CAST(doc_id AS VARCHAR) AS match_id, {_SEASON} AS season_year FROM documents")
def _(t: Tables):
    return t.match_docs.select("match_id", season_col(F.col("info.season"), F.col("info.dates")).alias("season_year"))


@check("flatten_outcome", f"""
SELECT CAST(doc_id AS VARCHAR) AS match_id, {_OUTCOME} AS outcome_type, {_MARGIN} AS outcome_margin FROM documents""")
def _(t: Tables):
    kind, margin = outcome_cols(F.col("info.outcome"))
    return t.match_docs.select("match_id", kind.alias("outcome_type"), margin.alias("outcome_margin"))


@check("venue_two_step", """
WITH grounds AS (SELECT p_brand AS venue_name, p_type AS city, min(p_partkey) AS venue_id FROM part WHERE p_size <= 25 GROUP BY ALL),
low AS (SELECT venue_name, min(venue_id) AS venue_id FROM grounds GROUP BY 1)
SELECT p_partkey, coalesce(g.venue_id, l.venue_id) AS venue_id, g.venue_id IS NOT NULL AS venue_exact
FROM part LEFT JOIN grounds g ON g.venue_name = p_brand AND g.city = CASE WHEN p_size > 40 THEN 'NOWHERE' ELSE p_type END
LEFT JOIN low l ON l.venue_name = p_brand""")
def _(t: Tables):
    grounds = t.part.where("p_size <= 25").groupBy(F.col("p_brand").alias("venue_name"), F.col("p_type").alias("city")).agg(
        F.min("p_partkey").alias("venue_id")
    )
    city = F.when(F.col("p_size") > 40, "NOWHERE").otherwise(F.col("p_type"))
    asked = t.part.select("p_partkey", F.col("p_brand").alias("venue_name"), city.alias("city"))
    return nm.attach_venue_two_step(asked, grounds).select("p_partkey", "venue_id", "venue_exact")


@check("norm_match_players", TEXT_VIEWS + """,
people AS (
  SELECT doc_id, lang, source, batter AS who, 1 AS side FROM seq UNION SELECT doc_id, lang, source, bowler, 2 FROM seq)
SELECT CAST(p.doc_id AS VARCHAR) AS match_id, who AS player_identifier, team_id
FROM (SELECT doc_id, lang, source, who, min(side) AS side FROM people GROUP BY ALL) p
JOIN teams ON team_name = CASE side WHEN 1 THEN 'Home ' || lang ELSE 'Away ' || source END""")
def _(t: Tables):
    return nm.match_players(t.stored_docs, t.teams)


@check("norm_awards", TEXT_VIEWS + """
SELECT CAST(doc_id AS VARCHAR) AS match_id, 'p:' || words[1][1] AS player_identifier FROM good WHERE len(words) > 0""")
def _(t: Tables):
    return nm.awards(t.good_docs)


@check("norm_officials", TEXT_VIEWS + """,
sizes AS (
  SELECT doc_id, length(w) AS size, min(CASE WHEN inning_number = 2 THEN 1000000 ELSE 0 END + over_number * 6 + ball_number) AS place
  FROM seq WHERE inning_number < 3 GROUP BY ALL),
firsts AS (SELECT doc_id, size, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS n FROM sizes)
SELECT CAST(doc_id AS VARCHAR) AS match_id, 'p:len' || size AS official_identifier, 'umpires' AS match_role FROM firsts WHERE n <= 2
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'p:' || words[1][-1], 'referee' FROM good WHERE len(words) > 0""")
def _(t: Tables):
    return nm.officials(parse_documents(document_text(t.good_docs)))


@check("norm_innings", TEXT_VIEWS + """
SELECT before_innings + inning_number AS inning_id, CAST(p.doc_id AS VARCHAR) AS match_id, inning_number,
       CASE WHEN inning_number = 2 THEN a.team_id ELSE h.team_id END AS batting_team_id,
       CASE WHEN inning_number = 2 THEN h.team_id ELSE a.team_id END AS bowling_team_id,
       CASE WHEN inning_number = 2 THEN CAST(len(ws) AS INTEGER) END AS target_runs,
       CASE WHEN inning_number = 2 THEN '20' END AS target_overs, inning_number = 3 AS is_super_over
FROM parts p JOIN ranges USING (doc_id) JOIN teams h ON h.team_name = 'Home ' || lang
JOIN teams a ON a.team_name = 'Away ' || source
WHERE p.doc_id NOT IN (SELECT doc_id FROM bad)""")
def _(t: Tables):
    return nm.innings(t.keyed_heads, t.teams_of(t.keyed_heads))


@check("norm_powerplays", TEXT_VIEWS + """
SELECT before_innings + inning_number AS inning_id, 'mandatory' AS type, CAST(0.1 AS DECIMAL(3, 1)) AS from_over,
       CAST(5.6 AS DECIMAL(3, 1)) AS to_over
FROM parts JOIN ranges USING (doc_id) WHERE doc_id NOT IN (SELECT doc_id FROM bad)""")
def _(t: Tables):
    return nm.powerplays(t.keyed_docs)


@check("norm_deliveries", TEXT_VIEWS + """
SELECT delivery_id, inning_id, CAST(over_number AS INTEGER) AS over_number, CAST(ball_number AS INTEGER) AS ball_number,
       batter AS batter_identifier, bowler AS bowler_identifier, partner AS non_striker_identifier,
       runs AS runs_batter, wide + noball AS runs_extras, upper AND runs = 4 AS runs_non_boundary,
       runs + wide + noball AS runs_total, wide AS extras_wides, noball AS extras_noballs, 0 AS extras_byes,
       0 AS extras_legbyes, 0 AS extras_penalty,
       CASE WHEN wide = 1 THEN '{"wides":1}' WHEN noball = 1 THEN '{"noballs":1}' END AS raw_extras_json,
       CASE WHEN size = 11 THEN '{"by":"Home","type":"wicket"}' END AS raw_review_json
FROM seq""")
def _(t: Tables):
    return nm.deliveries(t.keyed_docs)


_WICKETS = """,
falls AS (
  SELECT * EXCLUDE nth, before_wickets + row_number() OVER (PARTITION BY doc_id ORDER BY delivery_id, nth) AS wicket_id
  FROM (SELECT *, 1 AS nth, batter AS player_out, kind AS how FROM seq WHERE upper
        UNION ALL SELECT *, 2, partner, 'run out' FROM seq WHERE upper AND size > 9))
"""


@check("norm_wickets", TEXT_VIEWS + _WICKETS + """
SELECT wicket_id, delivery_id, player_out AS player_out_identifier, how AS kind,
       CASE WHEN how IN ('bowled', 'caught') THEN bowler END AS bowler_credited_identifier FROM falls""")
def _(t: Tables):
    return nm.wickets(t.keyed_docs)


@check("norm_fielders", TEXT_VIEWS + _WICKETS + """
SELECT wicket_id, partner AS fielder_player_identifier FROM falls WHERE how = 'caught'""")
def _(t: Tables):
    return nm.wicket_fielders(t.keyed_docs)


@check("norm_replacements", TEXT_VIEWS + """
SELECT match_id, delivery_id, inning_id, CASE WHEN size = 13 THEN 'match' ELSE 'role' END AS replacement_type,
       CASE WHEN size = 14 THEN 'bowler' END AS replaced_role,
       CASE WHEN size = 13 THEN batter ELSE bowler END AS player_in_identifier,
       CASE WHEN size = 13 THEN partner END AS player_out_identifier,
       CASE WHEN size = 13 THEN 'rule' ELSE 'injury' END AS reason, CAST(NULL AS BIGINT) AS team_id
FROM seq WHERE size IN (13, 14)""")
def _(t: Tables):
    return nm.replacements(t.keyed_docs, t.teams)


@check("norm_quarantine", TEXT_VIEWS + """
SELECT CAST(doc_id AS VARCHAR) AS match_id, 'name missing from registry' AS problem FROM bad""")
def _(t: Tables):
    bad = nm.split_valid(t.match_docs)[1]
    return bad.select("match_id", F.explode("problems").alias("problem"))


@check("norm_match_numbers", TEXT_VIEWS + """
SELECT match_id, match_no, CAST(sum(n_innings) OVER w - n_innings AS BIGINT) AS before_innings,
       CAST(sum(n_balls) OVER w - n_balls AS BIGINT) AS before_balls, CAST(sum(n_wickets) OVER w - n_wickets AS BIGINT) AS before_wickets
FROM (SELECT *, CAST(doc_id AS VARCHAR) AS match_id,
             row_number() OVER (ORDER BY substr(md5(CAST(doc_id AS VARCHAR)), 1, 3), CAST(doc_id AS VARCHAR)) AS match_no
      FROM counts) WINDOW w AS (ORDER BY match_no)""")
def _(t: Tables):
    return number_matches(with_key_counts(t.match_docs)).select("match_id", "match_no", *KEY_RANGES.values())


@check("norm_ball_fact", TEXT_VIEWS + _WICKETS + """,
outs AS (
  SELECT delivery_id, count(*) AS n, count(*) FILTER (player_out = batter) AS s,
         count(*) FILTER (how IN ('bowled', 'caught')) AS c, arg_min(how, wicket_id) AS kind FROM falls GROUP BY 1)
SELECT match_id, inning_id, inning_number, inning_number = 3 AS is_super_over, """ + _SEASON + """ AS season_year,
       CASE inning_number WHEN 2 THEN 'Away ' || source ELSE 'Home ' || lang END AS batting_team,
       CAST(over_number AS INTEGER) AS over_number, CAST(ball_number AS INTEGER) AS ball_number, s.delivery_id, batter,
       partner AS non_striker, bowler, runs AS runs_batter, runs + wide + noball AS runs_total, wide AS wides,
       noball AS noballs, 0 AS byes, 0 AS legbyes, CAST(coalesce(o.n, 0) AS INTEGER) AS outs,
       CAST(coalesce(o.s, 0) AS INTEGER) AS striker_outs, CAST(coalesce(o.c, 0) AS INTEGER) AS credited_outs, o.kind
FROM seq s LEFT JOIN outs o ON o.delivery_id = s.delivery_id""")
def _(t: Tables):
    return nm.balls(t.keyed_docs)


@check("an_raw_json_deliveries", TEXT_VIEWS + """
SELECT match_id, inning_number, over_number + 1 AS over_place, ball_number, w[1] AS batter, substr(bowler, 3) AS bowler,
       runs AS runs_batter, runs + wide + noball AS runs_total, wide AS wides, noball AS noballs, 0 AS byes, 0 AS legbyes,
       CASE WHEN upper AND size > 9 THEN 2 WHEN upper THEN 1 ELSE 0 END AS outs, CASE WHEN upper THEN kind END AS kind,
       CAST(upper AS INTEGER) AS striker_outs
FROM seq""")
def _(t: Tables):
    return nm.raw_deliveries(parse_documents(document_text(t.good_docs)))


@check("an_text_hat_trick", TEXT_VIEWS + """,
numbered AS (
  SELECT bowler, inning_id, upper AND size % 4 < 2 AS hit,
         row_number() OVER (PARTITION BY inning_id, bowler ORDER BY over_number, ball_number) AS n
  FROM seq),
hits AS (
  SELECT bowler, n, lag(n, 1) OVER w AS p, lag(n, 2) OVER w AS q FROM numbered WHERE hit
  WINDOW w AS (PARTITION BY inning_id, bowler ORDER BY n))
SELECT bowler, count(*) AS hat_tricks FROM hits WHERE n = p + 1 AND p = q + 1
GROUP BY bowler ORDER BY hat_tricks DESC, bowler LIMIT 10""")
def _(t: Tables):
    return an.hat_tricks(nm.balls(t.keyed_docs))

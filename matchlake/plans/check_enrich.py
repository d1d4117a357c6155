"""Enrichment data work over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions.names import short_name
from matchlake.functions.plan import spread
from matchlake.operators import enrich as en
from matchlake.plans.checks import check
from matchlake.plans.tables import Tables


def played(t: Tables) -> DataFrame:
    """Orders as matches at the nation of their customer."""
    matches = t.orders.select(
        F.col("o_orderkey").alias("match_id"), F.to_date("o_orderdate").alias("match_date"),
        F.year("o_orderdate").alias("season_year"), F.col("o_custkey").alias("match_number"),
        (F.col("o_custkey") % 25).alias("venue_id"), F.col("o_orderstatus").alias("team1_id"),
        F.substring("o_orderpriority", 1, 1).alias("team2_id"),
    )
    venues = t.nation.select(
        F.col("n_nationkey").alias("venue_id"), F.col("n_name").alias("venue_name"), F.col("n_regionkey").alias("city")
    )
    teams = t.orders.select(F.explode(F.array("o_orderstatus", F.substring("o_orderpriority", 1, 1))).alias("team_id")).distinct()
    return en.played_matches(matches, venues, teams.withColumn("team_name", F.concat(F.lit("T"), "team_id")))


_PLAYED = """
WITH played AS (
  SELECT o_orderkey AS match_id, CAST(o_orderdate AS DATE) AS match_date, CAST(year(o_orderdate) AS INTEGER) AS season_year, o_custkey,
         n_name AS venue_name, n_regionkey AS city, 'T' || o_orderstatus AS team1, 'T' || o_orderpriority[1] AS team2
  FROM orders JOIN nation ON n_nationkey = o_custkey % 25)
"""


@check("enrich_candidates", _PLAYED + """
SELECT c_custkey AS identifier, c_name AS name, c_mktsegment AS unique_name, match_date AS last_match_date, season_year AS last_season_year,
       o_custkey AS last_match_number, venue_name AS last_venue_name, city AS last_city, team1 || ' v/s ' || team2 AS last_match_played
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY match_date DESC, match_id DESC) AS place FROM played) JOIN customer ON c_custkey = o_custkey
WHERE place = 1 AND (c_mktsegment = 'BUILDING' OR c_acctbal < 0)""")
def _(t: Tables):
    people = t.customer.select(
        F.col("c_custkey").alias("identifier"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("unique_name"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("batting_hand"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("country"),
    )
    appearances = t.orders.select(F.col("o_orderkey").alias("match_id"), F.col("o_custkey").alias("player_identifier"))
    return en.players_missing(people, appearances, played(t), ["batting_hand", "country"])


@check("timing_candidates", _PLAYED + """,
innings AS (SELECT DISTINCT l_orderkey AS match_id, l_linenumber AS inning_number, l_orderkey * 100 + l_linenumber AS inning_id FROM lineitem WHERE l_linenumber < 3),
timed AS (SELECT l_orderkey * 100 + l_linenumber AS inning_id FROM lineitem WHERE l_linenumber = 2 AND l_returnflag = 'N')
SELECT match_id, season_year, match_date AS match_date_played, venue_name, team1, team2, a.inning_id AS inning_1_id, b.inning_id AS inning_2_id
FROM played JOIN innings a USING (match_id) JOIN innings b USING (match_id)
WHERE a.inning_number = 1 AND b.inning_number = 2 AND b.inning_id NOT IN (SELECT inning_id FROM timed)""")
def _(t: Tables):
    innings = t.lineitem.select(
        F.col("l_orderkey").alias("match_id"), F.col("l_linenumber").alias("inning_number"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("inning_id"), "l_returnflag", "l_shipdate",
    )
    known = innings.where("inning_number = 2").select(
        "inning_id", F.when(F.col("l_returnflag") == "N", F.col("l_shipdate")).alias("scheduled_starttime_utc")
    )
    return en.matches_missing_timing(played(t), innings, known)


@check("request_payload", """
WITH placed AS (
  SELECT *, row_number() OVER (ORDER BY substr(md5(CAST(c_custkey AS VARCHAR)), 1, 3), c_custkey) - 1 AS place FROM customer)
SELECT place // 5 AS batch, count(*) AS n,
       '[' || string_agg('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","day":"' ||
         strftime(DATE '2020-01-01' + c_nationkey, '%Y-%m-%d') || '"}', ',' ORDER BY c_custkey) || ']' AS payload
FROM placed GROUP BY 1""")
def _(t: Tables):
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_nationkey"))
    return en.payloads(t.customer.select("c_custkey", "c_name", day.alias("day")), ["c_custkey"], 5)


@check("context_text", """
SELECT c_custkey, '- name: "' || c_name || '"' || chr(10) || '- group: "' || coalesce(nullif(c_mktsegment, 'BUILDING'), 'None') || '"' AS context FROM customer""")
def _(t: Tables):
    rows = t.customer.select("c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return rows.select("c_custkey", en.context_text({"c_name": "name", "segment": "group"}).alias("context"))


@check("parse_responses", """
SELECT event_id, event_type <> 'error' AS readable, CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k FROM events""")
def _(t: Tables):
    fenced = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("```json\n"), "props", F.lit("\n```")))
        .when(F.col("event_type") == "error", F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("["), "props", F.lit("]"))).otherwise("sorry"))
        .otherwise(F.concat(F.lit("  "), "props"))
    )
    good, bad = en.parse_replies(t.events.select("event_id", fenced.alias("reply")), "reply", "STRUCT<k: INT>")
    return good.select("event_id", F.lit(True).alias("readable"), F.col("parsed.k").alias("k")).unionByName(
        bad.select("event_id", F.lit(False).alias("readable"), F.lit(None).cast("int").alias("k"))
    )


@check("validate_attributes", """
SELECT c_custkey, list_filter([CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN 'c_mktsegment' END,
  CASE WHEN c_nationkey > 9 THEN 'c_nationkey' END], lambda x: x IS NOT NULL) AS invalid FROM customer""")
def _(t: Tables):
    domains = {"c_mktsegment": ["BUILDING", "MACHINERY", "HOUSEHOLD"], "c_nationkey": list(range(10))}
    return en.validate(t.customer, domains).select("c_custkey", "invalid")


@check("merge_attributes", """
SELECT s_suppkey AS identifier, CASE WHEN s_acctbal < 3000 THEN 'Right-arm' WHEN s_acctbal < 6000 THEN 'old' END AS bowling_hand,
       CASE WHEN s_acctbal < 3000 AND s_nationkey > 5 THEN DATE '1990-05-06' END AS date_of_birth FROM supplier""")
def _(t: Tables):
    people = t.supplier.select(
        F.col("s_suppkey").alias("identifier"), F.when(F.col("s_acctbal") < 6000, "old").alias("bowling_hand"),
        F.lit(None).cast("date").alias("date_of_birth"),
    )
    replies = t.supplier.where("s_acctbal < 3000").select(
        F.col("s_suppkey").alias("identifier"), F.lit("Right-arm").alias("bowling_hand"),
        F.when(F.col("s_nationkey") > 5, "1990-05-06").otherwise("1900-01-01").alias("date_of_birth"),
    ).union(t.nation.select((F.col("n_nationkey") - 100).cast("long"), F.lit("Left-arm"), F.lit("1980-01-01")))
    return en.merge_attributes(people, replies)


@check("normalise_codes", """
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'RFM/RAFM' WHEN p_size % 3 = 1 THEN 'LS/LAS' ELSE p_brand END AS style FROM part""")
def _(t: Tables):
    style = F.when(F.col("p_size") % 3 == 0, "RAFM").when(F.col("p_size") % 3 == 1, "LS").otherwise(F.col("p_brand"))
    return en.recode(t.part.select("p_partkey", style.alias("style")), "style")


@check("first_last_name", """
WITH n AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' Smith' WHEN 2 THEN p_name || ' De Wit' ELSE split_part(p_name, ' ', 1) END AS full_name FROM part)
SELECT p_partkey, full_name, CASE WHEN full_name LIKE '% De Wit' THEN split_part(full_name, ' ', 1) || ' De Wit'
  WHEN full_name LIKE '% Smith' THEN split_part(full_name, ' ', 1) || ' Smith' ELSE full_name END AS first_last_name FROM n""")
def _(t: Tables):
    k, name = F.col("p_size") % 4, F.col("p_name")
    full = (
        F.when(k == 0, name).when(k == 1, F.concat(name, F.lit(" Smith"))).when(k == 2, F.concat(name, F.lit(" De Wit")))
        .otherwise(F.split(name, " ")[0])
    )
    named = t.part.select("p_partkey", full.alias("full_name"))
    return named.withColumn("first_last_name", short_name(F.col("full_name")))


@check("reset_unresolved", """
SELECT p_partkey AS identifier, CASE WHEN p_size > 40 AND p_type = 'ECONOMY' THEN NULL WHEN p_size > 40 THEN 'N/A' ELSE 'x' END AS country,
       CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE p_name END AS full_name FROM part""")
def _(t: Tables):
    text = F.when(F.col("p_size") > 40, "N/A").otherwise("x")
    people = t.part.select(
        F.col("p_partkey").alias("identifier"),
        *[text.alias(c) for c in ["batting_hand", "bowling_hand", "player_role", "country", "bowling_style"]],
        F.lit(None).cast("date").alias("date_of_birth"),
        F.when(F.col("p_type") != "ECONOMY", F.col("p_name")).alias("full_name"),
    )
    return en.reset_unresolved(people).select("identifier", "country", "full_name")


def timing_replies(t: Tables) -> DataFrame:
    """Events as timing replies: the day and time of an event start an innings, errors come without a time."""
    clock = F.date_format("ts", "HH:mm:ss")
    delay = F.struct(
        F.col("event_type").alias("reason"), clock.alias("start_time_utc"), F.lit(None).cast("string").alias("resume_time_utc"),
        F.hour("ts").alias("duration_minutes"), F.lit(3.5).alias("overs_completed"),
    )
    inning = F.struct(
        F.col("event_id").alias("inning_id"), F.hour("ts").alias("total_duration_minutes"), F.minute("ts").alias("playing_duration_minutes"),
        F.when(F.col("event_type") != "error", clock).alias("actual_starttime_utc"),
        F.lit("25:99:00").alias("actual_endtime_utc"), clock.alias("scheduled_starttime_utc"),
        F.when(F.col("event_type") == "view", F.array(delay, delay)).alias("delays"),
    )
    game = F.struct(
        F.col("event_id").cast("string").alias("match_id"), F.date_format("ts", "yyyy-MM-dd").alias("match_date_played"),
        inning.alias("innings_1"),
    )
    text = F.concat(F.lit("```json\n"), F.to_json(F.array(game)), F.lit("\n```"))
    return en.parse_timing_replies(spread(t.events, "event_id").select(text.alias("reply")))[0]


@check("build_timings", """
SELECT event_id AS inning_id, CAST(hour(ts) AS INTEGER) AS total_duration_minutes, CAST(minute(ts) AS INTEGER) AS playing_duration_minutes,
       CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS actual_starttime_utc, CAST(NULL AS TIMESTAMP) AS actual_endtime_utc,
       date_trunc('second', ts) AS scheduled_starttime_utc FROM events""")
def _(t: Tables):
    return en.timings(timing_replies(t))


@check("merge_timings", """
SELECT event_id AS inning_id, CAST(hour(ts) AS INTEGER) AS total_duration_minutes, CAST(minute(ts) AS INTEGER) AS playing_duration_minutes,
       CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS actual_starttime_utc, TIMESTAMP '2024-01-01' AS actual_endtime_utc,
       date_trunc('second', ts) AS scheduled_starttime_utc FROM events""")
def _(t: Tables):
    known = t.events.select(
        F.col("event_id").alias("inning_id"), F.lit(1).alias("total_duration_minutes"), F.lit(None).cast("int").alias("playing_duration_minutes"),
        F.lit(None).cast("timestamp").alias("actual_starttime_utc"), F.lit("2024-01-01").cast("timestamp").alias("actual_endtime_utc"),
        F.lit(None).cast("timestamp").alias("scheduled_starttime_utc"),
    )
    return en.merge_timings(known, en.timings(timing_replies(t)))


@check("build_delays", """
SELECT event_id AS inning_id, event_type AS reason, date_trunc('second', ts) AS start_time_utc, CAST(NULL AS TIMESTAMP) AS resume_time_utc,
       CAST(hour(ts) AS INTEGER) AS duration_minutes, 3.5 AS overs_completed FROM events WHERE event_type = 'view'""")
def _(t: Tables):
    return en.delays(timing_replies(t))

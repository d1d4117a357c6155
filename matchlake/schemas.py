"""Schemas of the raw documents, the people file and the star tables."""

from __future__ import annotations

# The columns of the people file as it is now (reading it goes by its header).
PEOPLE_COLUMNS = [
    "identifier", "name", "unique_name", "key_bcci", "key_bcci_2", "key_bigbash", "key_cricbuzz", "key_cricheroes",
    "key_crichq", "key_cricinfo", "key_cricinfo_2", "key_cricinfo_3", "key_cricingif", "key_cricketarchive",
    "key_cricketarchive_2", "key_cricketworld", "key_nvplay", "key_nvplay_2", "key_opta", "key_opta_2", "key_pulse",
    "key_pulse_2",
]

_REPLACEMENT = "`in` STRING, `out` STRING, reason STRING"

DELIVERY = (
    "STRUCT<batter: STRING, bowler: STRING, non_striker: STRING,"
    " runs: STRUCT<batter: INT, extras: INT, non_boundary: BOOLEAN, total: INT>,"
    " extras: STRUCT<wides: INT, noballs: INT, byes: INT, legbyes: INT, penalty: INT>,"
    " review: VARIANT,"
    " wickets: ARRAY<STRUCT<player_out: STRING, kind: STRING, fielders: ARRAY<STRUCT<name: STRING>>>>,"
    " replacements: STRUCT<"
    "match: ARRAY<STRUCT<team: STRING, `in`: STRING, `out`: STRING, reason: STRING>>,"
    " role: ARRAY<STRUCT<role: STRING, `in`: STRING, `out`: STRING, reason: STRING>>>>"
)

INNINGS = (
    "ARRAY<STRUCT<team: STRING, super_over: BOOLEAN,"
    " target: STRUCT<runs: INT, overs: STRING>,"
    " powerplays: ARRAY<STRUCT<type: STRING, `from`: DECIMAL(3,1), `to`: DECIMAL(3,1)>>,"
    f" overs: ARRAY<STRUCT<over: INT, deliveries: ARRAY<{DELIVERY}>>>>>"
)

# Officials come as a list of names or as one name, so their values are read as variants and made lists afterwards.
INFO = (
    "STRUCT<teams: ARRAY<STRING>, season: STRING, dates: ARRAY<STRING>, venue: STRING, city: STRING,"
    " toss: STRUCT<winner: STRING, decision: STRING>,"
    " outcome: STRUCT<winner: STRING, result: STRING, `by`: STRUCT<wickets: INT, runs: INT>>,"
    " event: STRUCT<name: STRING, match_number: INT>,"
    " match_type: STRING, overs: INT, balls_per_over: INT,"
    " players: MAP<STRING, ARRAY<STRING>>, player_of_match: ARRAY<STRING>,"
    " officials: MAP<STRING, VARIANT>, registry: STRUCT<people: MAP<STRING, STRING>>>"
)

DOCUMENT = f"STRUCT<info: {INFO}, innings: {INNINGS}>"

# Meaning of columns that is not plain from their names; attached to the star tables as column comments.
COMMENTS = {
    "is_super_over": "tie-break innings; left out of statistics unless asked for",
    "ball_number": "place in the over's list of balls, from 1; wides and no-balls count, so it can pass 6",
    "runs_total": "runs_batter + runs_extras",
    "bowler_credited": "the bowler, or NULL where the dismissal is not the bowler's",
    "target_runs": "only set for the second innings",
    "target_overs": "kept as text, as it is given",
}

PLAYER_REPLY = (
    "STRUCT<batting_hand: STRING, bowling_hand: STRING, bowling_style: STRING, date_of_birth: STRING,"
    " country: STRING, player_role: STRING, full_name: STRING>"
)

_DELAY = (
    "STRUCT<reason: STRING, start_time_utc: STRING, resume_time_utc: STRING, duration_minutes: INT,"
    " overs_completed: DOUBLE>"
)
_INNINGS_REPLY = (
    "STRUCT<inning_id: BIGINT, total_duration_minutes: INT, playing_duration_minutes: INT,"
    " actual_starttime_utc: STRING, actual_endtime_utc: STRING, scheduled_starttime_utc: STRING,"
    f" delays: ARRAY<{_DELAY}>>"
)
TIMING_REPLY = (
    f"ARRAY<STRUCT<match_id: STRING, match_date_played: STRING, innings_1: {_INNINGS_REPLY},"
    f" innings_2: {_INNINGS_REPLY}>>"
)

"""Data work around the enrichment of players and match timings; the replies themselves come from outside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.fixed_values import (
    BATTING_HANDS, BOWLING_HANDS, BOWLING_STYLES, MAX_ROWS, PLAYER_ATTRIBUTES, PLAYER_ROLES, STYLE_PAIRS,
    TEXT_ATTRIBUTES, UNKNOWN, UNKNOWN_BIRTH_DATE,
)
from matchlake.functions.names import short_name
from matchlake.functions.plan import with_once
from matchlake.operators.maintain import latest_values, upsert
from matchlake.operators.ranking import batches
from matchlake.operators.vetting import strip_fences
from matchlake.schemas import PLAYER_REPLY, TIMING_REPLY


def played_matches(matches: DataFrame, venues: DataFrame, teams: DataFrame) -> DataFrame:
    """Matches with venue and both teams known, with their readable description."""
    one = teams.select(F.col("team_id").alias("team1_id"), F.col("team_name").alias("team1"))
    two = teams.select(F.col("team_id").alias("team2_id"), F.col("team_name").alias("team2"))
    return (
        matches.join(venues.select("venue_id", "venue_name", "city"), "venue_id").join(one, "team1_id").join(two, "team2_id")
        .withColumn("match_played", F.concat_ws(" v/s ", "team1", "team2"))
    )


def players_missing(
    players: DataFrame, appearances: DataFrame, played: DataFrame, attributes: Sequence[str] = PLAYER_ATTRIBUTES,
    n: int | None = None,
) -> DataFrame:
    """Players that lack an attribute, with their latest match; the first ``n`` by identifier, or all.

    The latest match is picked by a partial aggregation of (date, match) per player, and only that one match is
    joined back; players that lack nothing are left out before their matches are looked at.
    """
    open_ = F.lit(False)
    for a in attributes:
        open_ = open_ | F.col(a).isNull()
    wanted = players.where(open_).select("identifier", "name", "unique_name")
    dates = appearances.join(played.select("match_id", "match_date"), "match_id").join(
        wanted.select(F.col("identifier").alias("player_identifier")), "player_identifier", "left_semi"
    )
    latest = dates.groupBy(F.col("player_identifier").alias("identifier")).agg(
        F.max(F.struct("match_date", "match_id")).getField("match_id").alias("match_id")
    )
    facts = played.select(
        "match_id", F.col("match_date").alias("last_match_date"), F.col("season_year").alias("last_season_year"),
        F.col("match_number").alias("last_match_number"), F.col("venue_name").alias("last_venue_name"),
        F.col("city").alias("last_city"), F.col("match_played").alias("last_match_played"),
    )
    found = wanted.join(latest, "identifier").join(facts, "match_id").drop("match_id")
    return found if n is None else found.orderBy("identifier").limit(n)


def matches_missing_timing(
    played: DataFrame, innings: DataFrame, timings: DataFrame, n: int | None = None
) -> DataFrame:
    """Matches with two innings whose second has no timing or no scheduled start; the newest ``n``, or all."""
    pairs = innings.where(F.col("inning_number").isin(1, 2)).groupBy("match_id").agg(
        F.max(F.when(F.col("inning_number") == 1, F.col("inning_id"))).alias("inning_1_id"),
        F.max(F.when(F.col("inning_number") == 2, F.col("inning_id"))).alias("inning_2_id"),
    ).where("inning_1_id IS NOT NULL AND inning_2_id IS NOT NULL")
    timed = timings.where("scheduled_starttime_utc IS NOT NULL").select(F.col("inning_id").alias("inning_2_id"))
    found = played.join(pairs.join(timed, "inning_2_id", "left_anti"), "match_id").select(
        "match_id", "season_year", F.col("match_date").alias("match_date_played"), "venue_name", "team1", "team2",
        "inning_1_id", "inning_2_id",
    )
    if n is None:
        return found
    return found.orderBy(
        F.desc_nulls_last("season_year"), F.desc_nulls_last("match_date_played"), F.asc("match_id")
    ).limit(n)


def context_text(labels: dict[str, str]) -> Column:
    """One line ``- label: "value"`` per column; a missing value is written as None."""
    lines = [
        F.concat(F.lit(f'- {label}: "'), F.coalesce(F.col(c).cast("string"), F.lit("None")), F.lit('"'))
        for c, label in labels.items()
    ]
    return F.concat_ws("\n", *lines)


def payloads(df: DataFrame, key: Sequence[str], size: int = MAX_ROWS) -> DataFrame:
    """One JSON array per batch of ``size`` rows (the last may be shorter), dates in ISO form: (batch, n, payload)."""
    columns = df.columns
    rows = batches(df, key, size)
    listed = rows.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct(*key, F.struct(*columns).alias("_row")))).alias("rows")
    )
    return listed.select("batch", "n", F.to_json(F.transform("rows", lambda r: r["_row"])).alias("payload"))


def parse_replies(df: DataFrame, reply: str, schema: str, many: bool = False) -> tuple[DataFrame, DataFrame]:
    """Replies without their code fence, parsed into ``parsed``, and the rejects.

    Rejected is what is no JSON, or no array where ``many`` rows are asked for, or no object otherwise.
    """
    bare = with_once(df, "_text", strip_fences(F.col(reply), "json"))
    fits = F.try_parse_json("_text").isNotNull() & F.col("_text").startswith("[" if many else "{")
    judged = with_once(bare, "_fits", F.coalesce(fits, F.lit(False)))
    good = with_once(judged.where("_fits"), "parsed", F.from_json("_text", schema)).drop("_fits", "_text")
    return good, judged.where("NOT _fits").drop("_fits", "_text")


def parse_player_replies(df: DataFrame, reply: str = "reply") -> tuple[DataFrame, DataFrame]:
    return parse_replies(df, reply, PLAYER_REPLY)


def parse_timing_replies(df: DataFrame, reply: str = "reply") -> tuple[DataFrame, DataFrame]:
    return parse_replies(df, reply, TIMING_REPLY, many=True)


ATTRIBUTE_DOMAINS = {
    "batting_hand": [*BATTING_HANDS, UNKNOWN],
    "bowling_hand": [*BOWLING_HANDS, UNKNOWN],
    "player_role": [*PLAYER_ROLES, UNKNOWN],
    "bowling_style": [*BOWLING_STYLES, UNKNOWN],
}


def validate(df: DataFrame, domains: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Add ``invalid``: the names of the columns whose value is not allowed; a missing value is no fault."""
    bad = [
        F.when(F.col(c).isNotNull() & ~F.col(c).isin(list(allowed)), F.lit(c))
        for c, allowed in (domains or ATTRIBUTE_DOMAINS).items()
    ]
    return df.withColumn("invalid", F.array_compact(F.array(*bad)))


def merge_attributes(
    players: DataFrame, replies: DataFrame, attributes: Sequence[str] = PLAYER_ATTRIBUTES, key: str = "identifier",
    order: Sequence[str] = (),
) -> DataFrame:
    """Fill the attributes of known players from replies; a new value wins, a missing one does not.

    Of several replies for a player, each attribute's last value by the columns ``order`` counts. The stand-in birth date of unknown people is no value.
    """
    columns = [c for c in attributes if c in replies.columns]
    given = [
        F.nullif(F.col(c).cast("string"), F.lit(UNKNOWN_BIRTH_DATE)).try_cast("date").alias(c) if c == "date_of_birth" else F.col(c)
        for c in columns
    ]
    known = replies.select(key, *order, *given).join(players.select(key), key, "left_semi")
    return upsert(players, latest_values(known, [key], order), [key], "coalesce")


def recode(df: DataFrame, column: str, mapping: dict[str, str] = STYLE_PAIRS) -> DataFrame:
    """Replace the codes that ``mapping`` knows."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return df.withColumn(column, F.coalesce(F.try_element_at(table, F.col(column)), F.col(column)))


def with_short_names(players: DataFrame, pairs: bool = False) -> DataFrame:
    """Set ``first_last_name`` from ``full_name``."""
    return players.withColumn("first_last_name", short_name(F.col("full_name"), pairs))


def reset_unresolved(players: DataFrame) -> DataFrame:
    """Players for whom nothing was found at all are opened again: all their attributes become NULL."""
    nothing = F.col("full_name").isNull()
    for c in TEXT_ATTRIBUTES:
        nothing = nothing & (F.col(c) == UNKNOWN)
    nothing = F.coalesce(nothing, F.lit(False))
    return players.select(*[F.when(~nothing, F.col(c)).alias(c) if c in PLAYER_ATTRIBUTES else F.col(c) for c in players.columns])


def _moment(day: str, time: str) -> Column:
    """UTC time of a day; NULL if either is missing or no time."""
    both = F.when(F.col(day).isNotNull() & F.col(time).isNotNull(), F.concat_ws(" ", day, time))
    return F.try_to_timestamp(both, F.lit("yyyy-MM-dd HH:mm:ss"))


def _innings_of(replies: DataFrame) -> DataFrame:
    """One row per innings of every match in the parsed timing replies."""
    games = replies.select(F.explode("parsed").alias("m"))
    return games.select(
        F.col("m.match_id").alias("match_id"), F.col("m.match_date_played").alias("day"),
        F.explode(F.array("m.innings_1", "m.innings_2")).alias("i"),
    ).where(F.col("i.inning_id").isNotNull())


def timings(replies: DataFrame) -> DataFrame:
    """Timing row of every innings in the replies."""
    return _innings_of(replies).select("day", "i.*").select(
        "inning_id", "total_duration_minutes", "playing_duration_minutes",
        *[_moment("day", c).alias(c) for c in ["actual_starttime_utc", "actual_endtime_utc", "scheduled_starttime_utc"]],
    )


def merge_timings(known: DataFrame, new: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Known timings with what the new ones add; a new value wins, a missing one does not.

    Of several new rows for an innings, each column's last value by the columns ``order`` counts.
    """
    return upsert(known, latest_values(new, ["inning_id"], order), ["inning_id"], "coalesce")


def delays(replies: DataFrame) -> DataFrame:
    """Delays of every innings in the replies, the same delay once."""
    rows = _innings_of(replies).select("day", F.col("i.inning_id").alias("inning_id"), F.explode("i.delays").alias("d"))
    return rows.select("day", "inning_id", "d.*").select(
        "inning_id", "reason", _moment("day", "start_time_utc").alias("start_time_utc"),
        _moment("day", "resume_time_utc").alias("resume_time_utc"), "duration_minutes", "overs_completed",
    ).distinct()

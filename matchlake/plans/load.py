"""A whole load: staged documents and the people file in, star tables and the ball fact out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchlake.operators import normalise as nm
from matchlake.operators.maintain import ForeignKey, NotNull, Unique, assign_key, Check
from matchlake.schemas import COMMENTS
from matchlake.session import configure, cut_lineage
from matchlake.sources.documents import attach_numbers, number_matches, parse_documents, with_key_counts
from matchlake.sources.people import load_players
from matchlake.sources.snapshots import stored, write_ball_fact, write_table

# Keys that later loads must not change; read back before they are written again.
KEY_TABLES = ["match_numbers", "teams", "venues", "players"]


def with_comments(df: DataFrame) -> DataFrame:
    """Attach the meaning of columns whose name does not tell it."""
    for column in df.columns:
        if column in COMMENTS:
            df = df.withMetadata(column, {"comment": COMMENTS[column]})
    return df


def _known(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """A table of an earlier load, taken out of its files so that these can be replaced."""
    path = f"{folder}/{name}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    return cut_lineage(spark.read.parquet(path))


def load(spark: SparkSession, staged: DataFrame, people: DataFrame, folder: str, full: bool = False) -> dict[str, DataFrame]:
    """Build all tables under ``folder`` and return them.

    ``staged`` holds every document (id, document), so a load is idempotent: running it again gives the same tables.
    Teams, venues, matches and players keep their keys from load to load; ``full`` starts the keys anew and only keeps
    the players. Documents that cannot be loaded whole end up in ``rejected_matches``.
    """
    configure(spark)
    known = {name: _known(spark, folder, name) for name in KEY_TABLES}
    if full:
        known = {name: table if name == "players" else None for name, table in known.items()}
    players = load_players(people, known["players"])
    players = stored(players, f"{folder}/players")

    # Parsed once. The keys of a match follow from the counts of all matches before it, so they are attached to what is stored.
    parsed = cut_lineage(with_key_counts(nm.judge(parse_documents(staged))))
    numbers = cut_lineage(number_matches(parsed, known["match_numbers"]))
    judged = stored(nm.judge_players(attach_numbers(parsed, numbers), players), f"{folder}/documents")
    fine, rejected = nm.split_judged(judged)

    # Teams and venues are looked up as tables: of a checkpoint the planner knows no size, and broadcasts the matches instead.
    keyed_teams = stored(with_comments(assign_key(nm.teams(fine), ["team_name"], "team_id", known["teams"])), f"{folder}/teams")
    named_venues = cut_lineage(nm.venues(fine))
    old_venues = known["venues"].select("venue_name", "venue_id") if known["venues"] is not None else None
    keyed_venues = stored(with_comments(
        assign_key(named_venues, ["venue_name"], "venue_id", old_venues).join(named_venues, "venue_name", "left")
    ), f"{folder}/venues")
    tables = {
        "match_numbers": numbers,
        "rejected_matches": rejected,
        "matches": nm.matches(fine, keyed_teams, keyed_venues),
        "match_players": nm.match_players(fine, keyed_teams),
        "awards": nm.awards(fine),
        "officials": nm.officials(fine),
        "innings": nm.innings(fine, keyed_teams),
        "powerplays": nm.powerplays(fine),
        "deliveries": nm.deliveries(fine),
        "wickets": nm.wickets(fine),
        "wicket_fielders": nm.wicket_fielders(fine),
        "replacements": nm.replacements(fine, keyed_teams),
    }
    for name, table in tables.items():
        write_table(with_comments(table), f"{folder}/{name}")
    write_ball_fact(with_comments(nm.balls(fine)), f"{folder}/balls")
    names = [*tables, "teams", "venues", "players", "balls"]
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


# What a load guarantees; operators.maintain.audit finds no row for these.
STAR_RULES = [
    NotNull("matches", "season_year"), Unique("matches", ("match_id",)), Unique("teams", ("team_name",)),
    Unique("venues", ("venue_name",)), Unique("match_players", ("match_id", "player_identifier")),
    Unique("officials", ("match_id", "official_identifier", "match_role")),
    Unique("innings", ("match_id", "inning_number")), Unique("innings", ("inning_id",)),
    Unique("deliveries", ("delivery_id",)), Unique("wickets", ("wicket_id",)),
    Unique("wicket_fielders", ("wicket_id", "fielder_player_identifier")),
    Check("matches", "two different teams", "team1_id <> team2_id"),
    Check("innings", "two different sides", "batting_team_id <> bowling_team_id"),
    Check("deliveries", "runs add up", "runs_total = runs_batter + runs_extras"),
    ForeignKey("match_players", ("match_id",), "matches", ("match_id",)),
    ForeignKey("match_players", ("player_identifier",), "players", ("identifier",)),
    ForeignKey("innings", ("match_id",), "matches", ("match_id",)),
    ForeignKey("deliveries", ("inning_id",), "innings", ("inning_id",)),
    ForeignKey("deliveries", ("batter_identifier",), "players", ("identifier",)),
    ForeignKey("deliveries", ("bowler_identifier",), "players", ("identifier",)),
    ForeignKey("wickets", ("delivery_id",), "deliveries", ("delivery_id",)),
    ForeignKey("wicket_fielders", ("wicket_id",), "wickets", ("wicket_id",)),
    ForeignKey("replacements", ("delivery_id",), "deliveries", ("delivery_id",)),
]

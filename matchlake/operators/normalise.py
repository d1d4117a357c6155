"""From typed match documents to the star tables and the ball fact.

``docs`` has match_id, info, innings and, for tables with keys, the key ranges of sources.documents.number_matches. A match
is one row, so what belongs to one match is looked up, checked and made unique inside that row: its balls become one list in
document order, and the ball tables are explosions of that list, or of what stands on its balls. A key is the match's range
and the place in the list; nothing is shuffled. Each table explodes once, and names are looked up behind that explosion.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.fixed_values import UNCREDITED_KINDS
from matchlake.functions.matches import outcome_cols, present, season_col
from matchlake.functions.plan import with_once
from matchlake.operators.maintain import attach_key

def _no_names() -> Column:
    return F.array().cast("array<string>")


def _list(column: Column, kind: str = "array<string>") -> Column:
    return F.coalesce(column, F.array().cast(kind))


def _registry() -> Column:
    return F.coalesce(F.col("info.registry.people"), F.create_map().cast("map<string,string>"))


def _person(name: Column, registry: Column | None = None) -> Column:
    """Identifier of a name in the match's own registry; an empty one counts as none."""
    return F.nullif(F.try_element_at(_registry() if registry is None else registry, name), F.lit(""))


#: A map is searched from its beginning, so a registry that every ball is looked up in is cut into so many.
_PARTS = 8


def _part(name: Column) -> Column:
    return F.pmod(F.hash(name), F.lit(_PARTS))


def _registry_parts() -> Column:
    """The match's registry as a list of maps, each name in that of its :func:`_part`."""
    parts = F.sequence(F.lit(0), F.lit(_PARTS - 1))
    return F.transform(parts, lambda part: F.map_filter(_registry(), lambda name, _: _part(name) == part))


def _listed(name: Column) -> Column:
    """As :func:`_person`, from the column ``registry`` made by :func:`_registry_parts`."""
    return _person(name, F.get(F.col("registry"), _part(name)))


def teams(docs: DataFrame) -> DataFrame:
    """Distinct trimmed team names from the team list, the toss, the outcome and the innings."""
    names = F.concat(
        _list(F.col("info.teams")), F.array(F.col("info.toss.winner"), F.col("info.outcome.winner")),
        _list(F.col("innings.team")),
    )
    trimmed = F.array_distinct(F.transform(names, lambda n: F.trim(n)))
    return docs.select(F.explode(trimmed).alias("team_name")).where(present(F.col("team_name"))).distinct()


def venues(docs: DataFrame) -> DataFrame:
    """One row per trimmed venue name, with the city of the lowest match id."""
    rows = docs.select(
        F.trim("info.venue").alias("venue_name"), F.nullif(F.trim("info.city"), F.lit("")).alias("city"), "match_id"
    ).where(present(F.col("venue_name")))
    return rows.groupBy("venue_name").agg(F.min_by("city", "match_id").alias("city"))


def attach_venue(df: DataFrame, venues: DataFrame) -> DataFrame:
    """Add ``venue_id`` by (venue_name, city), else by venue_name alone; ``venues`` is unique on venue_name.

    Since a venue name occurs once, both steps come to one lookup by name; ``venue_exact`` tells which one it was.
    """
    side = venues.select(F.col("venue_name").alias("_v"), F.col("city").alias("_c"), F.col("venue_id"))
    joined = df.join(side, F.col("venue_name") == F.col("_v"), "left")
    exact = F.col("venue_id").isNotNull() & F.col("city").eqNullSafe(F.col("_c"))
    return joined.withColumn("venue_exact", exact).drop("_v", "_c")


def attach_venue_two_step(df: DataFrame, venues: DataFrame) -> DataFrame:
    """As :func:`attach_venue` for a venue table with several cities per name: exact first, else the lowest id."""
    exact = venues.select(
        F.col("venue_name").alias("_v"), F.col("city").alias("_c"), F.col("venue_id").alias("_exact_id")
    )
    by_name = venues.groupBy(F.col("venue_name").alias("_n")).agg(F.min("venue_id").alias("_name_id"))
    both = (F.col("venue_name") == F.col("_v")) & F.col("city").eqNullSafe(F.col("_c"))
    return (
        df.join(exact, both, "left").join(by_name, F.col("venue_name") == F.col("_n"), "left")
        .withColumn("venue_id", F.coalesce("_exact_id", "_name_id"))
        .withColumn("venue_exact", F.col("_exact_id").isNotNull())
        .drop("_v", "_c", "_n", "_exact_id", "_name_id")
    )


def matches(docs: DataFrame, teams: DataFrame, venues: DataFrame) -> DataFrame:
    """One row per match; ``teams`` (team_id, team_name) and ``venues`` (venue_id, venue_name, city)."""
    kind, margin = outcome_cols(F.col("info.outcome"))
    flat = docs.select(
        "match_id",
        season_col(F.col("info.season"), F.col("info.dates")).alias("season_year"),
        F.get(F.col("info.dates"), F.lit(0)).try_cast("date").alias("match_date"),
        F.col("info.event.name").alias("event_name"),
        F.col("info.event.match_number").alias("match_number"),
        F.trim("info.venue").alias("venue_name"),
        F.nullif(F.trim("info.city"), F.lit("")).alias("city"),
        F.trim(F.get(F.col("info.teams"), F.lit(0))).alias("team1"),
        F.trim(F.get(F.col("info.teams"), F.lit(1))).alias("team2"),
        F.trim("info.toss.winner").alias("toss_winner"),
        F.col("info.toss.decision").alias("toss_decision"),
        F.trim("info.outcome.winner").alias("outcome_winner"),
        kind.alias("outcome_type"),
        margin.alias("outcome_margin"),
        F.col("info.match_type").alias("match_type"),
        F.col("info.overs").alias("overs_limit"),
        F.col("info.balls_per_over").alias("balls_per_over"),
    )
    keyed = attach_venue(flat, venues)
    for name in ["team1", "team2", "toss_winner", "outcome_winner"]:
        out = f"{name}_id" if name.startswith("team") else f"{name}_team_id"
        keyed = attach_key(keyed, teams, {name: "team_name"}, "team_id", out)
    return keyed.select(
        "match_id", "season_year", "match_date", "event_name", "match_number", "venue_id", "team1_id", "team2_id",
        "toss_winner_team_id", "toss_decision", "outcome_winner_team_id", "outcome_type", "outcome_margin",
        "match_type", "overs_limit", "balls_per_over",
    )


def match_players(docs: DataFrame, teams: DataFrame) -> DataFrame:
    """Players of each match with their team; a player named for two teams stays with the first known one.

    The team is looked up for a side, before its people become rows.
    """
    named = F.transform(F.map_entries("info.players"), lambda e: F.struct(F.trim(e["key"]).alias("team"), F.transform(e["value"], lambda n: _person(n)).alias("people")))
    lists = docs.select("match_id", F.posexplode(named).alias("place", "side"))
    sides = lists.select("match_id", "place", F.col("side.team").alias("team"), F.col("side.people").alias("people"))
    known = attach_key(sides, teams, {"team": "team_name"}, "team_id", "team_id").where("team_id IS NOT NULL")
    found = known.select("match_id", "place", "team_id", F.explode("people").alias("player_identifier"))
    return found.where("player_identifier IS NOT NULL").groupBy("match_id", "player_identifier").agg(
        F.min_by("team_id", "place").alias("team_id")
    )


def awards(docs: DataFrame) -> DataFrame:
    """Players of the match."""
    people = F.transform("info.player_of_match", lambda n: _person(n))
    return docs.select("match_id", F.explode(people).alias("player_identifier")).where("player_identifier IS NOT NULL")


def officials(docs: DataFrame) -> DataFrame:
    """Officials of each match by role, each once per role."""
    named = F.transform_values("info.officials", lambda _, names: F.array_distinct(F.transform(names, lambda n: _person(n))))
    roles = docs.select("match_id", F.explode(named).alias("match_role", "people"))
    return (
        roles.select("match_id", "match_role", F.explode("people").alias("official_identifier"))
        .where("official_identifier IS NOT NULL")
        .select("match_id", "official_identifier", "match_role")
    )


def _sides_known() -> Column:
    sides = F.col("info.teams")
    return (F.size(sides) == 2) & present(F.trim(F.get(sides, F.lit(0)))) & present(F.trim(F.get(sides, F.lit(1))))


def _innings_rows(docs: DataFrame) -> DataFrame:
    """Innings whose two sides are known; numbered in document order from 1."""
    rows = docs.where(_sides_known()).select(
        "match_id", "before_innings", F.transform("info.teams", lambda n: F.trim(n)).alias("sides"),
        F.posexplode(F.transform("innings", lambda i: i.dropFields("overs"))).alias("place", "inning"),
    )
    return rows.where(present(F.trim("inning.team"))).select(
        "*",
        (F.col("place") + 1).alias("inning_number"),
        (F.col("before_innings") + F.col("place") + 1).alias("inning_id"),
        F.trim("inning.team").alias("batting_team"),
        F.coalesce("inning.super_over", F.lit(False)).alias("is_super_over"),
    )


def innings(docs: DataFrame, teams: DataFrame) -> DataFrame:
    """Innings with batting and bowling side; the target belongs to the second innings only."""
    chase = F.col("inning_number") == 2
    side1, side2 = F.col("sides")[0], F.col("sides")[1]
    rows = _innings_rows(docs).select(
        "inning_id", "match_id", "inning_number", "batting_team",
        F.when(F.col("batting_team") == side1, side2).otherwise(side1).alias("bowling_team"),
        F.when(chase, F.col("inning.target.runs")).alias("target_runs"),
        F.when(chase, F.col("inning.target.overs")).alias("target_overs"),
        "is_super_over",
    )
    for side in ["batting", "bowling"]:
        rows = attach_key(rows, teams, {f"{side}_team": "team_name"}, "team_id", f"{side}_team_id")
    return rows.where("batting_team_id IS NOT NULL AND bowling_team_id IS NOT NULL").select(
        "inning_id", "match_id", "inning_number", "batting_team_id", "bowling_team_id", "target_runs", "target_overs",
        "is_super_over",
    )


def powerplays(docs: DataFrame) -> DataFrame:
    """Powerplays of each innings."""
    rows = _innings_rows(docs).select("inning_id", F.explode("inning.powerplays").alias("p"))
    return rows.select(
        "inning_id", F.col("p.type").alias("type"), F.col("p.from").alias("from_over"), F.col("p.to").alias("to_over")
    )


def _joined_up(lists: Column) -> Column:
    """The lists of a list, one after the other; NULL ones are empty."""
    return F.flatten(F.filter(lists, lambda x: x.isNotNull()))


def _ball_list() -> Column:
    """All balls of a match in document order: ``ball`` as it stands, and ``at``, its place in the match."""
    overs = _joined_up(F.col("innings.overs"))
    balls = _joined_up(overs["deliveries"])

    def spread(inning: Column, of_over: Callable[[Column], Column]) -> Column:
        bowled = F.filter(inning["overs"], lambda over: F.size(over["deliveries"]) > 0)
        return _joined_up(F.transform(bowled, of_over))

    def places(inning: Column, number: Column) -> Column:
        return spread(inning, lambda over: F.array_repeat(F.struct(
            (number + 1).alias("inning_number"), F.trim(inning["team"]).alias("team"), inning["super_over"].alias("super_over"),
            over["over"].alias("over_number")), F.size(over["deliveries"])))

    numbers = F.transform("innings", lambda inning: spread(inning, lambda over: F.sequence(F.lit(1), F.size(over["deliveries"]))))
    # Three lists in the same order, so a ball has the same place in each; nothing is evaluated ball by ball.
    return F.arrays_zip(balls.alias("ball"), _joined_up(F.transform("innings", places)).alias("at"), _joined_up(numbers).alias("ball_number"))


def _exploded(docs: DataFrame, list_: Column) -> DataFrame:
    """Rows (``row``) of a list of a match, with their ``place`` in it from 0, and the match's registry (in parts), season and key ranges."""
    ranges = ["match_id", "before_innings", "before_balls", "before_wickets"]
    season = season_col(F.col("info.season"), F.col("info.dates"))
    # In two steps, so that a row carries its match's registry and season, not all of ``info``.
    narrow = docs.where(_sides_known()).select(*ranges, _registry_parts().alias("registry"), season.alias("season_year"), "innings")
    return narrow.select(*ranges, "registry", "season_year", F.posexplode(list_).alias("place", "row"))


def _located(rows: DataFrame, place: Column) -> DataFrame:
    """Rows with their ball's people and keys, for balls that load.

    A ball of an innings without a team, or without batter, bowler or partner, is left out; it has taken its key and its
    number in the over.
    """
    played = rows.where(present(F.col("row.at.team")))
    people = F.struct(*[_listed(F.col(f"row.ball.{name}")).alias(name) for name in ("batter", "bowler", "non_striker")])
    return with_once(played, "people", people).dropna(subset=["people.batter", "people.bowler", "people.non_striker"]).select(
        "*", "people.*",
        F.col("row.at.team").alias("batting_team"), F.coalesce("row.at.super_over", F.lit(False)).alias("is_super_over"),
        F.col("row.at.inning_number").alias("inning_number"), F.col("row.at.over_number").alias("over_number"),
        F.col("row.ball_number").alias("ball_number"),
        (F.col("before_innings") + F.col("row.at.inning_number")).alias("inning_id"), (F.col("before_balls") + place + 1).alias("delivery_id"),
    )


def _ball_rows(docs: DataFrame) -> DataFrame:
    return _located(_exploded(docs, _ball_list()), F.col("place"))


def _on_balls(docs: DataFrame, of_ball: Callable[[Column], Column]) -> DataFrame:
    """Rows of the lists that ``of_ball`` makes of each ball, as ``row.entry`` with the ball's people and keys.

    ``place`` is that of the entry among all of the match. Balls without entries never become rows.
    """
    def entries(row: Column, place: Column) -> Column:
        people = F.struct(*[row["ball"][name].alias(name) for name in ("batter", "bowler", "non_striker")])
        return F.transform(of_ball(row["ball"]), lambda entry: F.struct(
            entry.alias("entry"), people.alias("ball"), row["at"].alias("at"), row["ball_number"].alias("ball_number"), place.alias("ball_place")))

    return _located(_exploded(docs, _joined_up(F.transform(_ball_list(), entries))), F.col("row.ball_place"))


def _extra(name: str, ball: str = "row.ball") -> Column:
    return F.coalesce(f"{ball}.extras.{name}", F.lit(0))


def _json_or_null(value: Column) -> Column:
    """JSON text of a sub-object; NULL when there is none or it is empty."""
    return F.nullif(F.to_json(value), F.lit("{}"))


def deliveries(docs: DataFrame) -> DataFrame:
    """The ball table: runs, extras and the raw sub-objects as JSON text."""
    return _ball_rows(docs).select(
        "delivery_id", "inning_id", "over_number", "ball_number",
        F.col("batter").alias("batter_identifier"),
        F.col("bowler").alias("bowler_identifier"),
        F.col("non_striker").alias("non_striker_identifier"),
        F.coalesce("row.ball.runs.batter", F.lit(0)).alias("runs_batter"),
        F.coalesce("row.ball.runs.extras", F.lit(0)).alias("runs_extras"),
        F.coalesce("row.ball.runs.non_boundary", F.lit(False)).alias("runs_non_boundary"),
        F.coalesce("row.ball.runs.total", F.lit(0)).alias("runs_total"),
        *[_extra(x).alias(f"extras_{x}") for x in ["wides", "noballs", "byes", "legbyes", "penalty"]],
        _json_or_null(F.col("row.ball.extras")).alias("raw_extras_json"),
        _json_or_null(F.col("row.ball.review")).alias("raw_review_json"),
    )


def _is_credited(kind: Column, uncredited: list[str]) -> Column:
    return ~F.coalesce(kind.isin(uncredited), F.lit(False))


def _wicket_rows(docs: DataFrame, uncredited: list[str]) -> DataFrame:
    kind = F.col("row.entry.kind")
    return _on_balls(docs, lambda ball: ball["wickets"]).select(
        (F.col("before_wickets") + F.col("place") + 1).alias("wicket_id"), "delivery_id", "registry", "row",
        _listed(F.col("row.entry.player_out")).alias("player_out_identifier"), kind.alias("kind"),
        F.when(_is_credited(kind, uncredited), F.col("bowler")).alias("bowler_credited_identifier"),
    ).where("player_out_identifier IS NOT NULL")


def wickets(docs: DataFrame, uncredited: list[str] = UNCREDITED_KINDS) -> DataFrame:
    """Dismissals; the bowler is credited unless the kind is not the bowler's."""
    return _wicket_rows(docs, uncredited).select(
        "wicket_id", "delivery_id", "player_out_identifier", "kind", "bowler_credited_identifier"
    )


def wicket_fielders(docs: DataFrame) -> DataFrame:
    """Fielders of each dismissal, each once."""
    people = F.array_distinct(F.transform("row.entry.fielders.name", _listed))
    return (
        _wicket_rows(docs, UNCREDITED_KINDS)
        .select("wicket_id", F.explode(people).alias("fielder_player_identifier"))
        .where("fielder_player_identifier IS NOT NULL")
    )


def replacements(docs: DataFrame, teams: DataFrame) -> DataFrame:
    """Replacements of both kinds: in the match (team, both players needed) and in a role (only the new one needed)."""
    text = F.lit(None).cast("string")

    def swaps(ball: Column) -> Column:
        changes = _list(ball["replacements"]["match"], "array<struct<team:string,in:string,out:string,reason:string>>")
        roles = _list(ball["replacements"]["role"], "array<struct<role:string,in:string,out:string,reason:string>>")
        return F.concat(
            F.transform(changes, lambda r: F.struct(
                F.lit("match").alias("type"), F.trim(r["team"]).alias("team"), text.alias("role"), r["in"].alias("came"),
                r["out"].alias("went"), r["reason"].alias("reason"))),
            F.transform(roles, lambda r: F.struct(
                F.lit("role").alias("type"), text.alias("team"), r["role"].alias("role"), r["in"].alias("came"),
                r["out"].alias("went"), r["reason"].alias("reason"))),
        )

    flat = _on_balls(docs, swaps).select(
        "match_id", "delivery_id", "inning_id", F.col("row.entry.team").alias("team"), F.col("row.entry.type").alias("replacement_type"),
        F.col("row.entry.role").alias("replaced_role"), _listed(F.col("row.entry.came")).alias("player_in_identifier"),
        _listed(F.col("row.entry.went")).alias("player_out_identifier"), F.col("row.entry.reason").alias("reason"),
    ).where("player_in_identifier IS NOT NULL AND (replacement_type = 'role' OR player_out_identifier IS NOT NULL)")
    return attach_key(flat, teams, {"team": "team_name"}, "team_id", "team_id").drop("team")


def balls(docs: DataFrame, uncredited: list[str] = UNCREDITED_KINDS) -> DataFrame:
    """The ball fact of operators.analytics, straight from the documents: no joins, no shuffle."""
    dismissals = F.filter(
        F.transform(
            _list(F.col("row.ball.wickets"), "array<struct<player_out:string,kind:string,fielders:array<struct<name:string>>>>"),
            lambda w: F.struct(_listed(w["player_out"]).alias("player_out"), w["kind"].alias("kind")),
        ),
        lambda w: w["player_out"].isNotNull(),
    )
    return _ball_rows(docs).withColumn("dismissals", dismissals).select(
        "match_id", "inning_id", "inning_number", "is_super_over", "season_year", "batting_team",
        "over_number", "ball_number", "delivery_id", "batter", "non_striker", "bowler",
        F.coalesce("row.ball.runs.batter", F.lit(0)).alias("runs_batter"),
        F.coalesce("row.ball.runs.total", F.lit(0)).alias("runs_total"),
        *[_extra(x).alias(x) for x in ["wides", "noballs", "byes", "legbyes"]],
        F.size("dismissals").alias("outs"),
        F.size(F.filter("dismissals", lambda w: w["player_out"] == F.col("batter"))).alias("striker_outs"),
        F.size(F.filter("dismissals", lambda w: _is_credited(w["kind"], uncredited))).alias("credited_outs"),
        F.get(F.col("dismissals"), F.lit(0))["kind"].alias("kind"),
    )


def balls_from_tables(
    deliveries: DataFrame, innings: DataFrame, matches: DataFrame, wickets: DataFrame
) -> DataFrame:
    """The ball fact from the star tables. Dismissals are summed per ball first, so none of them doubles its runs."""
    per_player = wickets.groupBy("delivery_id", "player_out_identifier").agg(
        F.count(F.lit(1)).alias("n"), F.count("bowler_credited_identifier").alias("c"),
        F.min(F.struct("wicket_id", "kind")).alias("first"),
    )
    with_out = deliveries.join(per_player, "delivery_id", "left")
    keys = ["delivery_id"]
    sums = with_out.groupBy(*keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("outs"),
        F.coalesce(F.sum(F.when(F.col("player_out_identifier") == F.col("batter_identifier"), F.col("n"))), F.lit(0)).alias("striker_outs"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("credited_outs"),
        F.min("first").getField("kind").alias("kind"),
        *[F.first(c).alias(c) for c in deliveries.columns if c not in keys],
    )
    games = matches.select("match_id", "season_year", "match_date")
    return (
        sums.join(innings.select("inning_id", "match_id", "inning_number", "is_super_over", "batting_team_id"), "inning_id")
        .join(games, "match_id")
        .select(
            "match_id", "inning_id", "inning_number", "is_super_over", "season_year", "match_date",
            F.col("batting_team_id").alias("batting_team"), "over_number", "ball_number", "delivery_id",
            F.col("batter_identifier").alias("batter"), F.col("non_striker_identifier").alias("non_striker"),
            F.col("bowler_identifier").alias("bowler"), "runs_batter", "runs_total",
            *[F.col(f"extras_{x}").alias(x) for x in ["wides", "noballs", "byes", "legbyes"]],
            "outs", "striker_outs", "credited_outs", "kind",
        )
    )


def raw_deliveries(docs: DataFrame) -> DataFrame:
    """Balls with their places, straight from the nested document; names are left as they are."""
    innings_rows = docs.select("match_id", F.posexplode("innings").alias("i", "inning"))
    overs = innings_rows.select("match_id", "i", F.posexplode("inning.overs").alias("o", "over"))
    rows = overs.select("match_id", "i", "o", F.posexplode("over.deliveries").alias("b", "ball"))
    return rows.select(
        "match_id", (F.col("i") + 1).alias("inning_number"), (F.col("o") + 1).alias("over_place"),
        (F.col("b") + 1).alias("ball_number"), F.col("ball.batter").alias("batter"), F.col("ball.bowler").alias("bowler"),
        F.col("ball.runs.batter").alias("runs_batter"), F.col("ball.runs.total").alias("runs_total"),
        *[_extra(x, "ball").alias(x) for x in ["wides", "noballs", "byes", "legbyes"]],
        F.coalesce(F.size("ball.wickets"), F.lit(0)).alias("outs"),
        F.get(F.col("ball.wickets"), F.lit(0))["kind"].alias("kind"),
        F.coalesce((F.get(F.col("ball.wickets"), F.lit(0))["player_out"] == F.col("ball.batter")).cast("int"), F.lit(0)).alias("striker_outs"),
    )


def _names_looked_up() -> Column:
    """Every name that the tables of a match need an identifier for."""

    def names(balls: Column) -> Column:
        # Field by field over all balls of an innings; only what stands on some balls is gathered from lists.
        outs, swaps = _joined_up(balls["wickets"]), _joined_up(balls["replacements"]["role"])
        changes = _joined_up(balls["replacements"]["match"])
        # Each name once: a list made by a lambda is copied name by name.
        return F.array_distinct(F.concat(
            balls["batter"], balls["bowler"], balls["non_striker"], outs["player_out"], _joined_up(outs["fielders"])["name"],
            changes["in"], changes["out"], swaps["in"], F.filter(swaps["out"], present),
        ))

    def of_innings(i: Column) -> Column:
        # An over without a list of balls leaves its innings unread. The list of one stands for a name of the balls.
        balls = F.flatten(i["overs"]["deliveries"])
        return _list(F.flatten(F.transform(F.array(balls), names)))

    played = F.filter("innings", lambda i: present(F.trim(i["team"])))
    return F.concat(
        _list(F.flatten(F.map_values("info.players"))), _list(F.col("info.player_of_match")),
        _list(F.flatten(F.map_values("info.officials"))),
        F.when(_sides_known(), _list(F.flatten(F.transform(played, of_innings)))).otherwise(_no_names()),
    )


def judge(docs: DataFrame) -> DataFrame:
    """Add ``problems``: why a match cannot be loaded, decided inside its own row; empty where it can be."""
    missing = F.array_except(_names_looked_up(), F.map_keys(_registry()))
    problems = F.array_compact(
        F.array(
            F.when(season_col(F.col("info.season"), F.col("info.dates")).isNull(), "no season"),
            F.when(F.size(missing) > 0, "name missing from registry"),
        )
    )
    return docs.withColumn("problems", problems)


def judge_players(judged: DataFrame, players: DataFrame) -> DataFrame:
    """Add to ``problems`` where a match refers to a person that is not in ``players`` (identifier).

    Only the distinct identifiers are compared with the players; the strangers among them are few.
    """
    used = judged.select("match_id", F.explode(F.array_distinct(F.map_values(_registry()))).alias("identifier")).where(
        present(F.col("identifier"))
    )
    strangers = used.select("identifier").distinct().join(players.select("identifier"), "identifier", "left_anti")
    marked = used.join(strangers, "identifier", "left_semi").select("match_id").distinct().withColumn("_odd", F.lit(True))
    more = F.when(F.col("_odd"), F.array(F.lit("unknown player"))).otherwise(_no_names())
    return judged.join(marked, "match_id", "left").withColumn("problems", F.concat("problems", more)).drop("_odd")


def split_judged(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Matches without problems, and the (match_id, problems) of the others."""
    fine = F.size("problems") == 0
    return judged.where(fine).drop("problems"), judged.where(~fine).select("match_id", "problems")


def split_valid(docs: DataFrame, players: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Matches that load and matches that do not (match_id, problems): one bad name keeps the whole match out.

    With ``players`` (identifier), matches that refer to an unknown person are kept out as well.
    """
    judged = judge(docs)
    return split_judged(judged if players is None else judge_players(judged, players))

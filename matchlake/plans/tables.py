"""The star-schema test tables seen as match data: views that give every operator something to read."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.fixed_values import UNCREDITED_KINDS
from matchlake.functions.plan import spread
from matchlake.operators.maintain import assign_key, assign_ranges
from matchlake.operators.normalise import split_valid, teams, venues
from matchlake.plans.text_matches import match_counts, match_documents
from matchlake.session import checkpoint_dir, configure, cut_lineage
from matchlake.sources.snapshots import stored


class Tables:
    """Lazy readers of the Parquet tables in one folder, and the match views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)

    @cached_property
    def balls(self) -> DataFrame:
        """One row per line item: a ball, without anything that only the order knows."""
        out = F.col("l_returnflag") == "R"
        kind = (
            F.when(~out, F.lit(None).cast("string"))
            .when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 7), "run out")
            .when(F.col("l_linestatus") == "O", "caught")
            .otherwise("bowled")
        )
        named = self.read("lineitem").select(
            F.col("l_orderkey").alias("match_id"),
            F.col("l_orderkey").alias("inning_id"),
            (1 + F.col("l_orderkey") % 2).cast("int").alias("inning_number"),
            (F.col("l_orderkey") % 97 == 0).alias("is_super_over"),
            F.col("l_linenumber").alias("over_number"),
            F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("ball_number"),
            (F.col("l_partkey") % 40).alias("batter"),
            ((F.col("l_partkey") % 40 + 1 + F.col("l_suppkey") % 39) % 40).alias("non_striker"),
            (F.col("l_suppkey") % 20).alias("bowler"),
            (F.col("l_quantity").cast("int") % 7).alias("runs_batter"),
            (F.col("l_discount") > 0.095).cast("int").alias("wides"),
            (F.col("l_tax") > 0.075).cast("int").alias("noballs"),
            F.lit(0).alias("byes"),
            F.lit(0).alias("legbyes"),
            out.cast("int").alias("outs"),
            kind.alias("kind"),
        )
        credited = F.col("kind").isNotNull() & ~F.col("kind").isin(UNCREDITED_KINDS)
        return named.select(
            "*",
            (F.col("runs_batter") + F.col("wides") + F.col("noballs")).alias("runs_total"),
            F.coalesce(credited, F.lit(False)).cast("int").alias("credited_outs"),
            ((F.col("outs") == 1) & (F.col("kind") != "run out")).cast("int").alias("striker_outs"),
        ).withColumn("striker_outs", F.coalesce("striker_outs", F.lit(0)))

    @cached_property
    def matches(self) -> DataFrame:
        """One row per order: a match."""
        return self.read("orders").select(
            F.col("o_orderkey").alias("match_id"),
            F.year("o_orderdate").alias("season_year"),
            F.to_date("o_orderdate").alias("match_date"),
            (F.col("o_custkey") % 10).alias("batting_team"),
            F.col("o_custkey").alias("host"),
            F.col("o_orderstatus").alias("toss"),
            F.col("o_orderpriority").alias("award"),
        )

    @cached_property
    def match_docs(self) -> DataFrame:
        """One row per text: a nested match document, already typed."""
        return match_documents(spread(self.read("documents"), "doc_id"))

    @cached_property
    def good_docs(self) -> DataFrame:
        """The match documents that load."""
        return split_valid(self.match_docs)[0]

    def scratch(self) -> str:
        """A new folder below the one that all executors share."""
        return f"{checkpoint_dir(self.spark)}/matchlake-{uuid.uuid4().hex}"

    @cached_property
    def stored_docs(self) -> DataFrame:
        """The heads of the match documents that load (all but the overs), written once as a table for all that need no balls."""
        return self.heads(self.good_docs)

    def heads(self, docs: DataFrame) -> DataFrame:
        """Documents without their overs, written as a table."""
        return stored(docs.withColumn("innings", F.transform("innings", lambda i: i.dropFields("overs"))), self.scratch())

    @cached_property
    def keyed_heads(self) -> DataFrame:
        """As ``stored_docs``, with the key ranges."""
        return self.heads(self.keyed_docs)

    @cached_property
    def keyed_docs(self) -> DataFrame:
        """The match documents that load, with the key ranges of their innings, balls and dismissals."""
        ranges = assign_ranges(cut_lineage(match_counts(spread(self.read("documents"), "doc_id"))))
        own = ranges.select(F.col("match_no").alias("doc_id"), *[c for c in ranges.columns if c.startswith("before_")])
        return split_valid(match_documents(spread(self.read("documents").join(own, "doc_id"), "doc_id")))[0]

    @cached_property
    def teams(self) -> DataFrame:
        """The team dimension, written once: the tables of the matches look it up many times."""
        return self.teams_of(self.stored_docs)

    def teams_of(self, docs: DataFrame) -> DataFrame:
        """The team dimension from documents that are stored already."""
        return stored(assign_key(teams(docs), ["team_name"], "team_id"), self.scratch())

    @cached_property
    def venues(self) -> DataFrame:
        """The venue dimension, written once."""
        named = cut_lineage(venues(self.stored_docs))
        return stored(named.join(assign_key(named, ["venue_name"], "venue_id"), "venue_name"), self.scratch())

    @cached_property
    def season_balls(self) -> DataFrame:
        """Balls with the season and team of their match."""
        return self.balls.join(self.matches, "match_id")

    @cached_property
    def match_venues(self) -> DataFrame:
        """Match and the nation of its customer as its venue."""
        homes = self.read("customer").select(F.col("c_custkey").alias("host"), F.col("c_nationkey").alias("n_nationkey"))
        nations = self.read("nation").select("n_nationkey", F.col("n_name").alias("venue"))
        return self.matches.join(homes, "host").join(nations, "n_nationkey").select(
            "match_id", "season_year", "match_date", "batting_team", "toss", "venue"
        )


# The same views for the SQL check. Every check text that uses them starts with this.
BALL_VIEWS = """
WITH matches AS (
  SELECT o_orderkey AS match_id, year(o_orderdate) AS season_year, CAST(o_orderdate AS DATE) AS match_date,
         o_custkey % 10 AS batting_team, o_custkey AS host, o_orderstatus AS toss
  FROM orders),
innings AS (
  SELECT o_orderkey AS inning_id, o_orderkey AS match_id, 1 + o_orderkey % 2 AS inning_number,
         o_orderkey % 97 = 0 AS is_super_over
  FROM orders),
deliveries AS (
  SELECT l_orderkey AS inning_id, l_linenumber AS over_number,
         row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS ball_seq,
         l_partkey % 40 AS batter, (l_partkey % 40 + 1 + l_suppkey % 39) % 40 AS non_striker,
         l_suppkey % 20 AS bowler, CAST(l_quantity AS INTEGER) % 7 AS runs_batter,
         CAST(l_discount > 0.095 AS INTEGER) AS wides, CAST(l_tax > 0.075 AS INTEGER) AS noballs,
         l_returnflag, l_linestatus, l_linenumber
  FROM lineitem),
wickets AS (
  SELECT inning_id, ball_seq, kind, CASE WHEN kind = 'run out' THEN non_striker ELSE batter END AS player_out,
         CASE WHEN kind <> 'run out' THEN bowler END AS credited
  FROM (SELECT *, CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN 'run out'
                       WHEN l_linestatus = 'O' THEN 'caught' ELSE 'bowled' END AS kind
        FROM deliveries WHERE l_returnflag = 'R')),
balls AS (
  SELECT d.*, i.match_id, i.inning_number, i.is_super_over, m.season_year, m.match_date, m.batting_team, m.host,
         w.kind, w.player_out, w.credited
  FROM deliveries d
  JOIN innings i USING (inning_id)
  JOIN matches m USING (match_id)
  LEFT JOIN wickets w ON w.inning_id = d.inning_id AND w.ball_seq = d.ball_seq)
"""


def sql_ratio(num: str, den: str, digits: int = 2, scale: int = 1) -> str:
    """SQL for a ratio of whole numbers rounded half up, NULL on a zero divisor."""
    unit = 10**digits
    return f"(((({num}) * {2 * scale * unit} + ({den})) // nullif(2 * ({den}), 0)) / {float(unit)})"

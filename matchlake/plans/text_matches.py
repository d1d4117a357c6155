"""Match documents made of the text table: every document is a match, every word of it a ball.

Words are bowled in overs of six; the first half of a text is the first innings, the rest the second, and some texts
have a tie-break of their first six words. Names come from letters and word lengths; names with digits are missing from
the registry, so texts with such words are matches that must not load.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantVal

from matchlake.functions.plan import with_once


# The helpers of tasks are pickled by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Texts are made into balls in runs of about so many bytes; a longer text on its own.
_RUN = 1 << 19
_SOLID = ~np.isin(np.arange(256), list(b" \n\t\r"))
_KINDS = ("bowled", "caught", "run out", "retired out")

_OVERS = """array<struct<over:int,deliveries:array<struct<batter:string,bowler:string,non_striker:string,
  runs:struct<batter:int,extras:int,non_boundary:boolean,total:int>,
  extras:struct<wides:int,noballs:int,byes:int,legbyes:int,penalty:int>,review:variant,
  wickets:array<struct<player_out:string,kind:string,fielders:array<struct<name:string>>>>,
  replacements:struct<match:array<struct<team:string,in:string,out:string,reason:string>>,
    role:array<struct<role:string,in:string,out:string,reason:string>>>>>>>"""


def _is_upper(w: Column) -> Column:
    """Words that begin with one of A to Z; ``[`` follows Z."""
    return (w >= F.lit("A")) & (w < F.lit("["))


def _is_digit(w: Column) -> Column:
    """Names that begin with one of 0 to 9; ``:`` follows 9."""
    return (w >= F.lit("0")) & (w < F.lit(":"))


def _struct(**fields: pa.Array) -> pa.StructArray:
    return pa.StructArray.from_arrays(list(fields.values()), list(fields))


def _nulls(n: int, kind: pa.DataType) -> pa.Array:
    return pa.nulls(n, kind)


def _lists(counts: np.ndarray, values: pa.Array, missing: np.ndarray | None = None) -> pa.ListArray:
    """Lists of so many of the ``values`` each, in their order; NULL where ``missing``."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=None if missing is None else pa.array(missing))


def _cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.StringArray:
    """The strings from ``starts`` to ``ends`` in a run of bytes."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], ends - starts)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[at]))


def _ints(values: np.ndarray, given: np.ndarray | None = None) -> pa.Array:
    return pa.array(values.astype(np.int32), mask=None if given is None else ~given)


def _first_seen(row: np.ndarray, name: np.ndarray, names: pa.Array, texts: int, missing: np.ndarray) -> pa.ListArray:
    """Of each text the distinct ``names`` (told apart by the number ``name``), in order."""
    at = np.sort(np.unique(row * (1 << 32) + name, return_index=True)[1])
    return _lists(np.bincount(row[at], minlength=texts), names.take(pa.array(at)), missing)


def _deliveries(batter: pa.Array, bowler: pa.Array, partner: pa.Array, size: np.ndarray, upper: np.ndarray, end: np.ndarray) -> pa.StructArray:
    """The balls of words, given by first letter, length, last letter, whether they begin upper and what they end with."""
    n, runs, extra = len(size), size % 7, np.minimum(end, 1)
    # Dismissals: one for a word that begins upper, two for a long one.
    outs = np.where(upper, np.where(size > 9, 2, 1), 0)
    ball = np.repeat(np.arange(n), outs)
    second = np.concatenate([[False], ball[1:] == ball[:-1]]) if len(ball) else np.zeros(0, bool)
    kind = np.where(second, 2, size[ball] % 4)
    caught = ~second & (kind == 1)
    at = pa.array(ball)
    out = pc.if_else(pa.array(second), partner.take(at), batter.take(at))
    catchers = _struct(name=partner.take(pa.array(np.repeat(ball[caught], 2))))
    wickets = _struct(player_out=out, kind=pa.array(_KINDS).take(pa.array(kind)), fielders=_lists(2 * caught, catchers))
    # Replacements: in the match for words of 13 letters, in a role for those of 14.
    change, swap = np.flatnonzero(size == 13), np.flatnonzero(size == 14)
    text = lambda what, some: pa.array([what]).take(pa.array(np.zeros(len(some), np.int64)))
    changes = pa.StructArray.from_arrays(
        [text(" Home ", change), batter.take(pa.array(change)), partner.take(pa.array(change)), text("rule", change)], ["team", "in", "out", "reason"])
    swaps = pa.StructArray.from_arrays(
        [text("bowler", swap), bowler.take(pa.array(swap)), _nulls(len(swap), pa.string()), text("injury", swap)], ["role", "in", "out", "reason"])
    replaced = pa.StructArray.from_arrays(
        [_lists(size == 13, changes), _lists(size == 14, swaps)], ["match", "role"], mask=pa.array((size != 13) & (size != 14)))
    seen = pa.array(np.where(size == 11, 0, -1), mask=size != 11)
    review = VariantVal.parseJson('{"by":"Home","type":"wicket"}')
    reviews = pa.StructArray.from_arrays(
        [pa.array([review.value], pa.binary()).take(seen), pa.array([review.metadata], pa.binary()).take(seen)],
        fields=[pa.field("value", pa.binary()), pa.field("metadata", pa.binary(), metadata={"variant": "true"})], mask=pa.array(size != 11))
    return _struct(
        batter=batter, bowler=bowler, non_striker=partner,
        runs=_struct(batter=_ints(runs), extras=_ints(extra), non_boundary=pa.array(np.ones(n, bool), mask=~(upper & (runs == 4))), total=_ints(runs + extra)),
        extras=_struct(wides=_ints(end, end == 1), noballs=_ints(extra, end == 2), **{x: _nulls(n, pa.int32()) for x in ("byes", "legbyes", "penalty")}),
        review=reviews, wickets=_lists(outs, wickets, ~upper), replacements=replaced,
    )


def _overs(counts: np.ndarray, balls: pa.Array) -> pa.ListArray:
    """For each of ``counts`` a list of overs of six, of so many of the ``balls`` in their order."""
    many = -(-counts // 6)
    number = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    bowled = np.minimum(6, np.repeat(counts, many) - 6 * number)
    return _lists(many, _struct(over=_ints(number), deliveries=_lists(bowled, balls)))


def _bowled(text: pa.Array) -> list[pa.Array]:
    """Of each text its number of words, its distinct batters, partners and bowlers, the overs of its two innings and of a tie-break."""
    n, missing = len(text), np.asarray(text.is_null())
    given = text.fill_null("")
    edges = np.frombuffer(given.buffers()[1], np.int32)[given.offset : given.offset + n + 1].astype(np.int64)
    data = np.frombuffer(given.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    solid = np.concatenate([_SOLID[data], [False]])
    fresh = np.concatenate([[True], ~solid[:-1]])
    fresh[edges] = True
    starts = np.flatnonzero(solid & fresh)
    closes = np.concatenate([~solid[1:] | fresh[1:], [True]])
    ends = np.flatnonzero(solid & closes) + 1
    counts = np.diff(np.searchsorted(starts, edges))
    row = np.repeat(np.arange(n), counts)
    # Letters may take several bytes; each begins with one that does not go on another.
    begins = (data & 0xC0) != 0x80
    begins[starts] = True
    letters, upto = np.concatenate([np.flatnonzero(begins), [len(data)]]), np.cumsum(begins)
    first, last = upto[starts] - 1, upto[ends - 1] - 1
    size = last - first + 1
    batter, partner = _cut(data, starts, letters[first + 1]), _cut(data, letters[last], ends)
    bowler = pc.binary_join_element_wise("len", pa.array(size).cast(pa.string()), "")
    wide = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.int64)
    code = lambda a, z: sum(np.where(a + k < z, wide[np.minimum(a + k, len(data))], 0) << (8 * k) for k in range(4))
    ending = wide[ends - 1]
    upper = (wide[starts] >= 65) & (wide[starts] < 91)
    balls = _deliveries(batter, bowler, partner, size, upper, np.where(ending == 44, 1, np.where(ending == 46, 2, 0)))
    seen = [_first_seen(row, code(starts, letters[first + 1]), batter, n, missing), _first_seen(row, code(letters[last], ends), partner, n, missing),
            _first_seen(row, size, bowler, n, missing)]
    halves = np.stack([counts // 2, counts - counts // 2], axis=1).reshape(-1)
    again = np.minimum(counts, 6)
    at = np.arange(again.sum()) + np.repeat(np.cumsum(counts) - counts - np.cumsum(again) + again, again)
    return [_ints(counts, ~missing), *seen, _lists(np.full(n, 2), _overs(halves, balls)), _overs(again, balls.take(pa.array(at)))]


def _with_balls(documents: DataFrame) -> DataFrame:
    """Texts with what :func:`_bowled` makes of them in place of ``text``; worked out on columns of many words at once."""
    kept = [c for c in documents.columns if c != "text"]
    names = ["size", "batters", "partners", "bowlers", "played", "again"]
    more = f"size int, batters array<string>, partners array<string>, bowlers array<string>, played array<{_OVERS}>, again {_OVERS}"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            long = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
            ends, first = np.cumsum(long, dtype=np.int64), 0
            while first < len(batch):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] - long[first] + _RUN, "right")))
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *_bowled(part.column("text"))], [*kept, *names])
                first = last

    return documents.select(*kept, "text").mapInArrow(make, ",".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*kept).schema], more]))


def _inning(team: Column, super_over: Column, overs: Column, count: Column) -> Column:
    return F.struct(
        team.alias("team"), super_over.alias("super_over"),
        F.struct(count.alias("runs"), F.lit("20").alias("overs")).alias("target"),
        F.array(
            F.struct(
                F.lit("mandatory").alias("type"), F.lit(0.1).cast("decimal(3,1)").alias("from"),
                F.lit(5.6).cast("decimal(3,1)").alias("to"),
            )
        ).alias("powerplays"),
        overs.alias("overs"),
    )


def _words() -> Column:
    return F.array_remove(F.split("text", "[ \n\t\r]+"), "")


def match_counts(documents: DataFrame) -> DataFrame:
    """How many innings, balls and dismissals the document of each text will have, without building it."""
    words = with_once(documents.select("doc_id", "n_chars", "text"), "words", _words())
    extra = F.col("n_chars") % 5 == 0
    outs = lambda ws: F.aggregate(ws, F.lit(0), lambda n, w: n + F.when(~_is_upper(w), 0).when(F.length(w) > 9, 2).otherwise(1))
    tie_break = F.slice("words", 1, 6)
    return words.select(
        F.col("doc_id").cast("string").alias("match_id"), F.col("doc_id").alias("match_no"),
        F.when(extra, 3).otherwise(2).cast("long").alias("n_innings"),
        (F.size("words") + F.when(extra, F.size(tie_break)).otherwise(0)).cast("long").alias("n_balls"),
        (outs("words") + F.when(extra, outs(tie_break)).otherwise(0)).cast("long").alias("n_wickets"),
    )


def match_documents(documents: DataFrame) -> DataFrame:
    """match_id, match_no, info and innings for every text; key ranges are kept."""
    ranges = [c for c in documents.columns if c.startswith("before_")]
    columns = documents.select("doc_id", "lang", "source", "n_chars", "text", *ranges)
    split = _with_balls(columns).withColumn("half", F.floor(F.col("size") / 2).cast("int"))
    batters, partners, bowlers = F.col("batters"), F.col("partners"), F.col("bowlers")
    known, size = F.col("known"), F.col("size")
    split = with_once(split, "known", F.filter(F.array_distinct(F.concat(batters, partners, bowlers)), lambda n: ~_is_digit(n)))
    home, away = F.concat(F.lit(" Home "), F.col("lang")), F.concat(F.lit("Away "), F.col("source"), F.lit(" "))
    registry = F.map_from_arrays(known, F.transform(known, lambda n: F.concat(F.lit("p:"), n)))
    season = (
        F.when(F.col("n_chars") % 3 == 0, (2000 + F.col("n_chars") % 20).cast("string"))
        .when(F.col("n_chars") % 3 == 1, "2007/08").otherwise("abc")
    )
    by = F.when(
        F.col("n_chars") % 4 < 2,
        F.struct(F.when(F.col("n_chars") % 4 == 0, 5).alias("wickets"), (F.col("n_chars") % 50).cast("int").alias("runs")),
    )
    result = F.when(F.col("n_chars") % 4 == 2, "tie")
    info = F.struct(
        F.array(home, away).alias("teams"), season.alias("season"),
        F.array((F.date_add(F.lit("2001-01-01").cast("date"), (F.col("doc_id") % 9000).cast("int"))).cast("string")).alias("dates"),
        F.concat(F.lit(" "), F.col("source"), F.lit(" ground")).alias("venue"),
        F.when(F.col("lang") != "en", F.col("lang")).alias("city"),
        F.struct(home.alias("winner"), F.when(F.col("n_chars") % 2 == 0, "bat").otherwise("field").alias("decision")).alias("toss"),
        F.struct(F.when(result.isNull(), away).alias("winner"), result.alias("result"), by.alias("by")).alias("outcome"),
        F.struct(F.col("source").alias("name"), F.col("n_chars").cast("int").alias("match_number")).alias("event"),
        F.lit("T20").alias("match_type"), F.lit(20).alias("overs"), F.lit(6).alias("balls_per_over"),
        F.create_map(home, batters, away, F.array_distinct(F.concat(bowlers, F.slice(batters, 1, 1)))).alias("players"),
        F.slice(batters, 1, 1).alias("player_of_match"),
        F.create_map(
            F.lit("umpires"), F.slice(bowlers, 1, 2), F.lit("referee"), F.slice(partners, 1, 1)
        ).alias("officials"),
        F.struct(registry.alias("people")).alias("registry"),
    )
    # A text that is not given has a tie-break of one over without a list of balls.
    again = F.when(size.isNull(), F.array(F.struct(F.lit(0).alias("over"), F.lit(None).alias("deliveries"))).cast(_OVERS)).otherwise(F.col("again"))
    tie_break = _inning(home, F.lit(True), again, F.least(F.lit(6), size))
    played = F.array(
        _inning(home, F.lit(None).cast("boolean"), F.get("played", F.lit(0)), F.col("half")),
        _inning(away, F.lit(None).cast("boolean"), F.get("played", F.lit(1)), size - F.col("half")),
    )
    innings = F.when(F.col("n_chars") % 5 == 0, F.concat(played, F.array(tie_break))).otherwise(played)
    built = with_once(split, "doc", F.struct(info.alias("info"), innings.alias("innings")))
    return built.select(F.col("doc_id").cast("string").alias("match_id"), F.col("doc_id").alias("match_no"), *ranges, "doc.*")


def document_text(docs: DataFrame) -> DataFrame:
    """The match documents as staged text (id, document); an only referee is written as a plain name, none as null."""
    officials = F.col("info.officials")
    as_given = F.create_map(
        F.lit("umpires"), F.parse_json(F.to_json(officials["umpires"])),
        F.lit("referee"), F.get(officials["referee"], F.lit(0)).cast("variant"),
    )
    doc = F.struct(F.col("info").withField("officials", as_given).alias("info"), F.col("innings"))
    return docs.select(F.col("match_id").alias("id"), F.to_json(doc).alias("document"))


# The same matches for the SQL check: ``texts`` per document, ``seq`` per ball, ``good`` for the matches that load.
TEXT_VIEWS = r"""
WITH texts AS (
  SELECT doc_id, lang, source, n_chars,
         list_filter(string_split_regex(text, '[ \n\t\r]+'), lambda w: w <> '') AS words
  FROM documents),
parts AS (
  SELECT doc_id, lang, source, n_chars, 1 AS inning_number, list_slice(words, 1, len(words) // 2) AS ws FROM texts
  UNION ALL SELECT doc_id, lang, source, n_chars, 2, list_slice(words, len(words) // 2 + 1, len(words)) FROM texts
  UNION ALL SELECT doc_id, lang, source, n_chars, 3, list_slice(words, 1, 6) FROM texts WHERE n_chars % 5 = 0),
cut AS (
  SELECT doc_id, lang, source, n_chars, inning_number, unnest(ws) AS w, unnest(range(len(ws))) AS k FROM parts),
bad AS (SELECT DISTINCT doc_id FROM cut WHERE w[1] SIMILAR TO '[0-9]' OR w[-1] SIMILAR TO '[0-9]'),
good AS (SELECT * FROM texts WHERE doc_id NOT IN (SELECT doc_id FROM bad)),
counts AS (
  SELECT doc_id, max(n_innings) AS n_innings, count(w) AS n_balls,
         coalesce(sum(CASE WHEN NOT regexp_matches(w, '^[A-Z]') THEN 0 WHEN length(w) > 9 THEN 2 ELSE 1 END), 0) AS n_wickets
  FROM (SELECT doc_id, CASE WHEN n_chars % 5 = 0 THEN 3 ELSE 2 END AS n_innings FROM texts) LEFT JOIN cut USING (doc_id) GROUP BY doc_id),
ranges AS (
  SELECT doc_id, CAST(sum(n_innings) OVER w - n_innings AS BIGINT) AS before_innings,
         CAST(sum(n_balls) OVER w - n_balls AS BIGINT) AS before_balls, CAST(sum(n_wickets) OVER w - n_wickets AS BIGINT) AS before_wickets
  FROM counts WINDOW w AS (ORDER BY doc_id)),
seq AS (
  SELECT CAST(doc_id AS VARCHAR) AS match_id, doc_id, lang, source, n_chars, inning_number, w, length(w) AS size,
         before_innings + inning_number AS inning_id, k // 6 AS over_number, k % 6 + 1 AS ball_number, before_wickets,
         before_balls + row_number() OVER (PARTITION BY doc_id ORDER BY inning_number, k) AS delivery_id,
         'p:' || w[1] AS batter, 'p:len' || length(w) AS bowler, 'p:' || w[-1] AS partner, length(w) % 7 AS runs,
         CAST(w LIKE '%,' AS INTEGER) AS wide, CAST(w LIKE '%.' AS INTEGER) AS noball,
         regexp_matches(w, '^[A-Z]') AS upper,
         CASE length(w) % 4 WHEN 0 THEN 'bowled' WHEN 1 THEN 'caught' WHEN 2 THEN 'run out' ELSE 'retired out' END AS kind
  FROM cut JOIN ranges USING (doc_id) WHERE doc_id NOT IN (SELECT doc_id FROM bad)),
team_names AS (SELECT DISTINCT 'Home ' || lang AS team_name FROM good UNION SELECT DISTINCT 'Away ' || source FROM good),
teams AS (SELECT team_name, row_number() OVER (ORDER BY substr(md5(team_name), 1, 3), team_name) AS team_id FROM team_names),
venue_names AS (
  SELECT source || ' ground' AS venue_name, arg_min(coalesce(nullif(lang, 'en'), '?'), CAST(doc_id AS VARCHAR)) AS city
  FROM good GROUP BY 1),
venues AS (
  SELECT venue_name, nullif(city, '?') AS city,
         row_number() OVER (ORDER BY substr(md5(venue_name), 1, 3), venue_name) AS venue_id FROM venue_names)
"""

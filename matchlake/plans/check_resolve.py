"""Name resolution over the names of the parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions.names import metaphone, searchable
from matchlake.operators import resolve as rs
from matchlake.plans.checks import check
from matchlake.plans.tables import Tables


def players(t: Tables) -> DataFrame:
    """Parts as people: the name is the part's, the unique name adds the brand in parentheses."""
    return t.part.select(
        F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("identifier"),
        F.col("p_name").alias("name"), F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")")).alias("unique_name"),
        F.concat("p_name", F.lit(" "), F.lower("p_type")).alias("full_name"),
        F.concat_ws(" ", F.split("p_name", " ")[0], F.lower("p_type")).alias("first_last_name"),
    )


PLAYERS = """
WITH players AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS identifier, p_name AS name, p_name || ' (' || p_brand || ')' AS unique_name,
         p_name || ' ' || lower(p_type) AS full_name, split_part(p_name, ' ', 1) || ' ' || lower(p_type) AS first_last_name
  FROM part),
typos AS (SELECT DISTINCT substr(p_name, 1, 3) || substr(p_name, 5) AS search_name FROM part)
"""


def typos(t: Tables) -> DataFrame:
    """Part names with their fourth letter lost."""
    return t.part.select(F.concat(F.substring("p_name", 1, 3), F.expr("substr(p_name, 5)")).alias("search_name")).distinct()


@check("nick_variants", """
WITH names AS (SELECT DISTINCT CASE WHEN p_name LIKE 'red %' THEN 'Mike ' || p_name WHEN p_name LIKE 'old %' THEN 'sam ' || substr(p_name, 5)
                                    ELSE p_name END AS search_name FROM part)
SELECT search_name, 1 AS priority, search_name AS variant FROM names
UNION ALL SELECT search_name, 2, CASE WHEN search_name LIKE 'Mike %' THEN 'michael red' ELSE 'samuel ' || split_part(search_name, ' ', 2) END
FROM names WHERE search_name LIKE 'Mike %' OR search_name LIKE 'sam %'""")
def _(t: Tables):
    name = (
        F.when(F.col("p_name").startswith("red "), F.concat(F.lit("Mike "), "p_name"))
        .when(F.col("p_name").startswith("old "), F.concat(F.lit("sam "), F.expr("substr(p_name, 5)")))
        .otherwise(F.col("p_name"))
    )
    return rs.variants(t.part.select(name.alias("search_name")))


@check("exact_cascade", PLAYERS + """,
names AS (SELECT DISTINCT upper(p_name) AS search_name FROM part UNION SELECT first_last_name FROM players
          UNION SELECT search_name FROM typos),
aliases AS (
  SELECT 1 AS level, lower(first_last_name) AS alias, identifier FROM players UNION ALL SELECT 2, lower(full_name), identifier FROM players
  UNION ALL SELECT 3, lower(unique_name), identifier FROM players UNION ALL SELECT 4, lower(name), identifier FROM players),
hits AS (
  SELECT search_name, level, min(identifier) AS identifier, count(DISTINCT identifier) AS n_candidates
  FROM names JOIN aliases ON alias = lower(search_name) GROUP BY ALL)
SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY search_name ORDER BY level) = 1""")
def _(t: Tables):
    people = players(t)
    names = t.part.select(F.upper("p_name").alias("search_name")).union(people.select("first_last_name")).union(typos(t))
    return rs.match_exact(rs.variants(names), people)


@check("alias_table", PLAYERS + """
SELECT alias, min(identifier) AS identifier FROM (
  SELECT unique_name AS alias, identifier FROM players UNION ALL SELECT name, identifier FROM players) GROUP BY alias""")
def _(t: Tables):
    return rs.alias_table(players(t))


@check("alias_resolve", PLAYERS + """,
names AS (SELECT DISTINCT p_name AS name FROM part UNION SELECT identifier FROM players UNION SELECT search_name FROM typos)
SELECT n.name, coalesce((SELECT min(identifier) FROM players p WHERE p.name = n.name),
                        (SELECT max(identifier) FROM players p WHERE p.identifier = n.name)) AS identifier FROM names n""")
def _(t: Tables):
    people = players(t)
    names = people.select("name").union(people.select("identifier")).union(typos(t))
    return rs.resolve_alias(names, people)


# Metaphone for the check, letter by letter with its neighbours: the rules that part names can meet.
_LETTERS = """
letters AS (SELECT name, '    ' || upper(name) || '    ' AS pad, unnest(range(1, length(name) + 1)) AS i FROM spoken),
near AS (SELECT name, i, substr(pad, i + 4, 1) AS c, substr(pad, i + 3, 1) AS p, substr(pad, i + 5, 1) AS n, substr(pad, i + 6, 1) AS nn
         FROM letters),
sounds AS (
  SELECT name, i, CASE
    WHEN i = 1 AND c IN ('A', 'E', 'I', 'O', 'U') THEN c
    WHEN i = 1 AND c || n IN ('GN', 'KN', 'PN') THEN 'N' WHEN i = 1 AND c = 'W' AND n IN ('A', 'E', 'I', 'O', 'U') THEN 'W'
    WHEN i = 2 AND p || c IN ('GN', 'KN', 'PN') THEN '' WHEN i = 2 AND p = 'W' AND c IN ('A', 'E', 'I', 'O', 'U') THEN ''
    WHEN c = p AND c <> 'C' THEN ''
    WHEN c = 'B' AND p = 'M' THEN ''
    WHEN c = 'C' AND n IN ('E', 'I', 'Y') THEN 'S' WHEN c = 'C' AND n = 'H' THEN 'X' WHEN c = 'C' THEN 'K'
    WHEN c = 'D' AND n = 'G' AND nn IN ('E', 'I', 'Y') THEN 'J' WHEN c = 'D' THEN 'T'
    WHEN c = 'G' AND p = 'D' AND n IN ('E', 'I', 'Y') THEN '' WHEN c = 'G' AND n IN ('E', 'I', 'Y') AND p <> 'G' THEN 'J' WHEN c = 'G' THEN 'K'
    WHEN c = 'H' AND NOT (n IN ('A', 'E', 'I', 'O', 'U') AND p NOT IN ('C', 'G', 'P', 'S', 'T')) THEN ''
    WHEN c = 'K' AND p = 'C' THEN '' WHEN c = 'P' AND n = 'H' THEN 'F' WHEN c = 'Q' THEN 'K' WHEN c = 'S' AND n = 'H' THEN 'X'
    WHEN c = 'T' AND n = 'H' THEN '0' WHEN c = 'V' THEN 'F' WHEN c IN ('W', 'Y') AND n NOT IN ('A', 'E', 'I', 'O', 'U') THEN ''
    WHEN c = 'X' THEN 'KS' WHEN c = 'Z' THEN 'S' WHEN c IN ('A', 'E', 'I', 'O', 'U') OR c NOT BETWEEN 'A' AND 'Z' THEN '' ELSE c END AS sound
  FROM near),
codes AS (SELECT name, string_agg(sound, '' ORDER BY i) AS code FROM sounds GROUP BY name)
"""


@check("phonetic_blocks", f"""
WITH spoken AS (SELECT DISTINCT p_name AS name FROM part), {_LETTERS}
SELECT code, p_partkey, min(p_partkey) OVER (PARTITION BY code) AS first_id, count(*) OVER (PARTITION BY code) AS block_size
FROM part JOIN codes ON name = p_name""")
def _(t: Tables):
    return rs.phonetic_blocks(t.part, "p_name", "p_partkey")[1]


@check("trigram_join", PLAYERS + """,
names AS (SELECT DISTINCT p_name AS name FROM part UNION SELECT search_name FROM typos),
grams AS (
  SELECT DISTINCT name, substr('  ' || word || ' ', i, 3) AS gram
  FROM (SELECT name, word, unnest(range(1, length(word) + 2)) AS i FROM (SELECT name, unnest(string_split(name, ' ')) AS word FROM names))),
sizes AS (SELECT name, count(*) AS n FROM grams GROUP BY name),
shared AS (
  SELECT a.name AS search_name, b.name AS p_name, count(*) AS c FROM grams a JOIN grams b USING (gram)
  WHERE a.name IN (SELECT search_name FROM typos) AND b.name IN (SELECT p_name FROM part) GROUP BY ALL)
SELECT search_name, p_name, CAST(c AS DOUBLE) / (x.n + y.n - c) AS sim
FROM shared JOIN sizes x ON x.name = search_name JOIN sizes y ON y.name = p_name
WHERE CAST(c AS DOUBLE) / (x.n + y.n - c) >= 0.3""")
def _(t: Tables):
    return rs.trigram_join(typos(t), t.part, "search_name", "p_name", 0.3, common=40)


_FUZZY = f""",
people AS (SELECT DISTINCT first_last_name AS f, full_name AS g, min(identifier) AS identifier, count(*) AS fame FROM players GROUP BY ALL),
spoken AS (SELECT search_name AS name FROM typos UNION SELECT f FROM people UNION SELECT g FROM people), {_LETTERS},
grams AS (
  SELECT DISTINCT code, substr('  ' || lower(code) || ' ', i, 3) AS gram
  FROM (SELECT code, unnest(range(1, length(code) + 2)) AS i FROM (SELECT DISTINCT code FROM codes))),
sizes AS (SELECT code, count(*) AS n FROM grams GROUP BY code),
common AS (SELECT p.code AS a, q.code AS b, count(*) AS c FROM grams p JOIN grams q USING (gram) GROUP BY ALL),
scored AS (
  SELECT search_name, identifier, fame, t.code AS code, cf.code AS c1, cg.code AS c2, levenshtein(t.code, cf.code) AS lv1,
         levenshtein(t.code, cg.code) AS lv2, CAST(coalesce(m1.c, 0) AS DOUBLE) / (n0.n + n1.n - coalesce(m1.c, 0)) AS sim1,
         CAST(coalesce(m2.c, 0) AS DOUBLE) / (n0.n + n2.n - coalesce(m2.c, 0)) AS sim2
  FROM typos JOIN codes t ON t.name = search_name CROSS JOIN people JOIN codes cf ON cf.name = f JOIN codes cg ON cg.name = g
  JOIN sizes n0 ON n0.code = t.code JOIN sizes n1 ON n1.code = cf.code JOIN sizes n2 ON n2.code = cg.code
  LEFT JOIN common m1 ON m1.a = t.code AND m1.b = cf.code LEFT JOIN common m2 ON m2.a = t.code AND m2.b = cg.code),
near_enough AS (
  SELECT *, (lv1 <= round(0.3 * greatest(length(code), length(c1))) AND sim1 >= 0.3)
         OR (lv2 <= round(0.3 * greatest(length(code), length(c2))) AND sim2 >= 0.3) AS fits FROM scored)
"""


@check("fuzzy_match", PLAYERS + _FUZZY + """
SELECT search_name, identifier, CAST(lv1 AS INTEGER) AS lv1, sim1 FROM near_enough WHERE fits
QUALIFY row_number() OVER (PARTITION BY search_name ORDER BY lv1, sim1 DESC, lv2, sim2 DESC, identifier) = 1""")
def _(t: Tables):
    return rs.match_fuzzy(rs.variants(typos(t)), players(t))


@check("fuzzy_match_popular", PLAYERS + _FUZZY + """,
fans AS (SELECT lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS identifier, count(*) AS popularity FROM lineitem GROUP BY 1),
all_people AS (SELECT p.identifier, first_last_name, full_name, popularity FROM players p LEFT JOIN fans USING (identifier))
SELECT n.search_name, a.identifier, CAST(lv1 AS INTEGER) AS lv1, sim1
FROM near_enough n JOIN people ON people.identifier = n.identifier
JOIN all_people a ON a.first_last_name = people.f AND a.full_name = people.g
WHERE fits OR contains(c1, code) OR contains(c2, code)
QUALIFY row_number() OVER (PARTITION BY n.search_name ORDER BY popularity DESC NULLS LAST, lv1, sim1 DESC, lv2, sim2 DESC, a.identifier) = 1""")
def _(t: Tables):
    fans = t.lineitem.groupBy(F.lpad(F.col("l_partkey").cast("string"), 12, "0").alias("identifier")).agg(
        F.count(F.lit(1)).alias("popularity")
    )
    return rs.match_fuzzy(rs.variants(typos(t)), players(t), popularity=fans)


@check("searchable_name", """
SELECT p_partkey, p_name || CASE WHEN lower(p_type) IN (SELECT unnest(string_split(p_name, ' '))) THEN '' ELSE ' ' || lower(p_type) END AS search_text
FROM part""")
def _(t: Tables):
    text = searchable(F.col("p_name"), F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")")), F.concat("p_name", F.lit(" "), "p_type"))
    return t.part.select("p_partkey", text.alias("search_text"))


@check("token_set_match")
def _(t: Tables):
    return rs.match_tokens(typos(t), players(t), 85)


@check("resolve_names")
def _(t: Tables):
    return rs.resolve_names(typos(t).union(t.part.select("p_name")), players(t))


@check("metaphone_codes", f"""
WITH spoken AS (SELECT DISTINCT p_name AS name FROM part), {_LETTERS} SELECT name, code FROM codes""")
def _(t: Tables):
    return t.part.select(F.col("p_name").alias("name")).distinct().withColumn("code", metaphone(F.col("name")))

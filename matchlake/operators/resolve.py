"""From free-text names to player identifiers, as joins over whole tables of names.

All pairings work on distinct names and codes, so a name that occurs a billion times is compared once, and homonyms
are reduced to their smallest identifier before anything is paired.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions.names import long_form, metaphone, ngrams, searchable, similarity, trigrams
from matchlake.functions.plan import with_once
from matchlake.session import cut_lineage

EXACT_LEVELS = ["first_last_name", "full_name", "unique_name", "name"]


def alias_table(players: DataFrame) -> DataFrame:
    """Alias to identifier: a name equal to the unique name first, then unique names, then names.

    Within the first level the last identifier counts, within the others the first.
    """
    name, unique = F.trim("name"), F.trim("unique_name")
    same = F.when(F.col("name") == F.col("unique_name"), name)
    entries = F.array(
        F.struct(F.lit(0).alias("level"), same.alias("alias")),
        F.struct(F.lit(1).alias("level"), unique.alias("alias")),
        F.struct(F.lit(2).alias("level"), name.alias("alias")),
    )
    rows = players.select("identifier", F.explode(entries).alias("e")).select("identifier", "e.*")

    def at(level: int) -> Column:
        return F.when(F.col("level") == level, F.col("identifier"))

    return rows.where(F.coalesce("alias", F.lit("")) != "").groupBy("alias").agg(
        F.coalesce(F.max(at(0)), F.min(at(1)), F.min(at(2))).alias("identifier")
    )


def resolve_alias(names: DataFrame, players: DataFrame, order: str = "name_first", column: str = "name") -> DataFrame:
    """Distinct names with the identifier they stand for, NULL where unknown.

    After the alias table, "name_first" takes an equal name or unique name and then an equal identifier;
    "identifier_first" an equal identifier and then an equal unique name.
    """
    known = alias_table(players).select(F.lit(0).alias("level"), "alias", "identifier")
    plain = {
        "name_first": [(1, "name"), (1, "unique_name"), (2, "identifier")],
        "identifier_first": [(1, "identifier"), (2, "unique_name")],
    }[order]
    entries = F.array(*[F.struct(F.lit(level).alias("level"), F.col(c).alias("alias")) for level, c in plain])
    more = players.select(F.explode(entries).alias("e"), "identifier").select("e.level", "e.alias", "identifier")
    best = known.unionByName(more).groupBy(F.col("alias").alias(column)).agg(
        F.min(F.struct("level", "identifier")).getField("identifier").alias("identifier")
    )
    return names.select(column).distinct().join(best, column, "left")


def variants(names: DataFrame, column: str = "search_name") -> DataFrame:
    """Distinct search names with the forms to try, in order: as given, then with the short first name written out."""
    forms = F.array_compact(
        F.array(
            F.struct(F.lit(1).alias("priority"), F.col(column).alias("variant")),
            F.when(
                long_form(F.col(column)).isNotNull(),
                F.struct(F.lit(2).alias("priority"), long_form(F.col(column)).alias("variant")),
            ),
        )
    )
    distinct = names.select(F.col(column).alias("search_name")).distinct()
    return distinct.select("search_name", F.explode(forms).alias("f")).select("search_name", "f.*")


def exact_names(players: DataFrame, levels: list[str] | None = None) -> DataFrame:
    """(level, alias, identifier, n_candidates): every lower-case name of every player, homonyms reduced to one row."""
    entries = F.array(
        *[F.struct(F.lit(i + 1).alias("level"), F.lower(c).alias("alias")) for i, c in enumerate(levels or EXACT_LEVELS)]
    )
    rows = players.where("identifier IS NOT NULL").select("identifier", F.explode(entries).alias("e"))
    return rows.where("e.alias IS NOT NULL").groupBy("e.level", "e.alias").agg(
        F.min("identifier").alias("identifier"), F.count_distinct("identifier").alias("n_candidates")
    )


def match_exact(variants: DataFrame, players: DataFrame, levels: list[str] | None = None) -> DataFrame:
    """The first hit of each search name: variants in order, and within a variant the name columns in order."""
    aliases = exact_names(players, levels)
    hits = variants.withColumn("alias", F.lower("variant")).join(aliases, "alias")
    best = hits.groupBy("search_name").agg(
        F.min(F.struct("priority", "level", "identifier", "n_candidates")).alias("best")
    )
    return best.select("search_name", "best.identifier", "best.level", "best.n_candidates")


def phonetic_blocks(players: DataFrame, name: str, identifier: str, code: str = "metaphone") -> tuple[DataFrame, DataFrame]:
    """The (code, identifier) block table, and each identifier's link to the first one of its block.

    Distinct names are coded once. A block is linked as a star around its smallest identifier, not pair by pair, so a
    block that holds a large part of all names stays linear.
    """
    coder = {"metaphone": metaphone, "soundex": F.soundex}[code]
    distinct = players.select(name).where(F.col(name).isNotNull()).distinct()
    codes = with_once(distinct, "code", coder(F.col(name)))
    blocks = players.join(codes, name).select("code", identifier)
    heads = blocks.groupBy("code").agg(F.min(identifier).alias("first_id"), F.count(F.lit(1)).alias("block_size"))
    return blocks, blocks.join(heads, "code").select("code", identifier, "first_id", "block_size")


def _by_rarity(names: DataFrame, column: str, grams: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Distinct names with ``grams``: their grams from the rarest to the most common, each with its frequency."""
    distinct = names.select(column, *keep).where(F.col(column).isNotNull()).distinct()
    rows = distinct.select(column, *keep, F.explode(grams).alias("gram"))
    frequency = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("freq"))
    # A name has no more grams than letters, so the list per name is short however many names there are.
    return rows.join(frequency, "gram").groupBy(column, *keep).agg(
        F.sort_array(F.collect_list(F.struct("freq", "gram"))).alias("grams")
    )


def _pair_keys(grams: Column, min_sim: float, common: int) -> Column:
    """Join keys such that every pair of names with the similarity shares one.

    Names that similar share enough grams that at least two of them lie in the rare-first prefixes of both. If one of
    the shared ones is rare it is a key by itself; two common ones are a key together. Names so short that one shared
    gram may be enough keep all their grams as keys among themselves.
    """
    n = F.size(grams)
    prefix = F.slice(grams, F.lit(1), F.least(n, n - F.ceil(n * F.lit(min_sim) - 1e-9).cast("int") + 2))
    rare = F.transform(F.filter(prefix, lambda g: g["freq"] <= common), lambda g: g["gram"])
    often = F.transform(F.filter(prefix, lambda g: g["freq"] > common), lambda g: g["gram"])  # rarest first
    together = F.flatten(
        F.transform(
            often,
            lambda a, i: F.transform(
                F.slice(often, i + 2, F.size(often)), lambda b: F.concat(a, F.lit("|"), b)
            ),
        )
    )
    alone = F.when(n <= int(1 / min_sim), F.transform(grams, lambda g: F.concat(F.lit("1:"), g["gram"])))
    return F.concat(rare, together, F.coalesce(alone, F.array().cast("array<string>")))


def trigram_join(
    left: DataFrame, right: DataFrame, left_name: str, right_name: str, min_sim: float = 0.3, common: int = 1000
) -> DataFrame:
    """All pairs of distinct names whose trigram similarity is at least ``min_sim``: (left_name, right_name, sim).

    Exact: ``common`` only decides which trigrams are paired up before joining, never whether a pair is found.
    """
    sides = left.select(F.col(left_name).alias("_name"), F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(F.col(right_name).alias("_name"), F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    both = sides.groupBy("_name").agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    ranked = _by_rarity(both, "_name", trigrams(F.col("_name")), ["_l", "_r"])
    keyed = ranked.select(
        "_name", "_l", "_r", F.transform("grams", lambda g: g["gram"]).alias("set"), F.size("grams").alias("size"),
        F.explode(_pair_keys(F.col("grams"), min_sim, common)).alias("key"),
    )
    a = keyed.where("_l = 1").select(F.col("_name").alias(left_name), F.col("set").alias("_a"), F.col("size").alias("_na"), "key")
    b = keyed.where("_r = 1").select(F.col("_name").alias("_right"), F.col("set").alias("_b"), F.col("size").alias("_nb"), F.col("key").alias("_key"))
    sim = similarity(F.col("_a"), F.col("_b"))
    # Sets whose sizes are too far apart cannot reach the similarity, whatever they share.
    near = F.least("_na", "_nb") >= F.greatest("_na", "_nb") * (min_sim - 1e-9)
    return (
        a.join(b, (F.col("key") == F.col("_key")) & near)
        .select(left_name, F.col("_right").alias(right_name if right_name != left_name else f"{right_name}_2"), sim.alias("sim"))
        .where(F.col("sim") >= min_sim - 1e-9)
        .distinct()
    )


def _containing(codes: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs (code, target) where the target contains the code; both tables hold distinct non-empty texts.

    A code is looked up by its rarest piece of up to three letters among the pieces of the targets.
    """
    pieces = F.concat(*[ngrams(F.col("target"), n) for n in (1, 2, 3)])
    index = targets.select("target", F.explode(pieces).alias("gram"))
    frequency = index.groupBy("gram").agg(F.count(F.lit(1)).alias("freq"))
    own = F.when(F.length("code") >= 3, ngrams(F.col("code"), 3)).otherwise(F.array("code"))
    wanted = codes.select("code", F.explode(own).alias("gram")).join(frequency, "gram").groupBy("code").agg(
        F.min_by("gram", F.struct("freq", "gram")).alias("gram")
    )
    return wanted.join(index, "gram").where(F.contains("target", "code")).select("code", "target")


def match_fuzzy(
    variants: DataFrame, players: DataFrame, ratio: float = 0.3, min_sim: float = 0.3,
    popularity: DataFrame | None = None,
) -> DataFrame:
    """The closest player by phonetic code for each search name: (search_name, identifier, lv1, sim1).

    A player qualifies when the code of the short or of the full name is within ``ratio`` edits and at least
    ``min_sim`` similar. With ``popularity`` (identifier, popularity), a code that contains the search code qualifies
    too and popularity comes first; a player without it comes last.
    """
    eligible = players.where("first_last_name IS NOT NULL AND identifier IS NOT NULL").select(
        "identifier", "first_last_name", "full_name"
    )
    spoken = with_once(
        eligible.select(F.explode(F.array("first_last_name", "full_name")).alias("name")).distinct(),
        "code", metaphone(F.col("name")),
    )
    named = eligible.join(
        spoken.select(F.col("name").alias("first_last_name"), F.col("code").alias("code1")), "first_last_name"
    ).join(
        spoken.select(F.col("name").alias("full_name"), F.col("code").alias("code2")), "full_name", "left"
    ).select("identifier", "code1", "code2")
    if popularity is None:
        named = named.withColumn("popularity", F.lit(None).cast("double"))
    else:
        named = named.join(popularity.select("identifier", F.col("popularity").cast("double")), "identifier", "left")
    fame = -F.coalesce("popularity", F.lit(float("-inf")))
    # Both code tables are used several times below; they are written once to the shared checkpoint folder.
    groups = cut_lineage(
        named.groupBy("code1", "code2").agg(F.min(F.struct(fame.alias("fame"), "identifier")).alias("who"))
    )
    coded = cut_lineage(with_once(variants, "code", metaphone(F.col("variant"))).select("search_name", "code"))
    codes = coded.select("code").where("code <> ''").distinct()
    targets = (
        groups.select(F.explode(F.array("code1", "code2")).alias("target")).where("target <> ''").distinct()
    )
    close = trigram_join(codes, targets, "code", "target", min_sim).where(
        F.levenshtein("code", "target") <= F.round(F.lit(ratio) * F.greatest(F.length("code"), F.length("target")))
    ).select("code", "target")
    if popularity is not None:
        close = close.unionByName(_containing(codes, targets)).distinct()
    by_code = groups.select(
        "code1", "code2", "who", F.explode(F.array_distinct(F.array_compact(F.array("code1", "code2")))).alias("target")
    )
    scored = coded.where("code <> ''").join(close, "code").join(by_code, "target").select(
        "search_name", "who",
        F.levenshtein("code", "code1").alias("lv1"),
        similarity(trigrams(F.col("code")), trigrams(F.col("code1"))).alias("sim1"),
        F.coalesce(F.levenshtein("code", "code2"), F.lit(1 << 30)).alias("lv2"),
        F.coalesce(similarity(trigrams(F.col("code")), trigrams(F.col("code2"))), F.lit(0.0)).alias("sim2"),
    )
    order = F.struct(
        F.col("who.fame").alias("fame"), "lv1", (-F.col("sim1")).alias("s1"), "lv2", (-F.col("sim2")).alias("s2"),
        F.col("who.identifier").alias("identifier"),
    )
    best = scored.groupBy("search_name").agg(F.min(order).alias("best"))
    return best.select(
        "search_name", F.col("best.identifier").alias("identifier"), F.col("best.lv1").alias("lv1"),
        (-F.col("best.s1")).alias("sim1"),
    )


def resolve_names(names: DataFrame, players: DataFrame, popularity: DataFrame | None = None) -> DataFrame:
    """Exact cascade, then the closest by sound: (search_name, identifier, method); NULL where nothing fits."""
    forms = variants(names)
    exact = match_exact(forms, players).select("search_name", "identifier", F.lit("exact").alias("method"))
    rest = forms.join(exact, "search_name", "left_anti")
    fuzzy = match_fuzzy(rest, players, popularity=popularity).select(
        "search_name", "identifier", F.lit("fuzzy").alias("method")
    )
    return forms.select("search_name").distinct().join(exact.unionByName(fuzzy), "search_name", "left")


def _ratio(a: str, b: str) -> int:
    return int(round(100 * SequenceMatcher(None, a, b).ratio())) if a and b else 0


def _partial(a: str, b: str) -> int:
    """Best ratio of the shorter text with an equally long piece of the other, at the places where they match."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 0
    best = 0.0
    for i, j, _ in SequenceMatcher(None, short, long).get_matching_blocks():
        piece = long[max(j - i, 0):max(j - i, 0) + len(short)]
        best = max(best, SequenceMatcher(None, short, piece).ratio())
    return 100 if best > 0.995 else int(round(100 * best))


def _token_set(a: str, b: str) -> int:
    x, y = set(a.split()), set(b.split())
    shared = " ".join(sorted(x & y))
    one = (shared + " " + " ".join(sorted(x - y))).strip()
    two = (shared + " " + " ".join(sorted(y - x))).strip()
    return max(_ratio(shared, one), _ratio(shared, two), _ratio(one, two))


def _score_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        scores = [
            (_token_set(t, s), _partial(t, f), _partial(t, u))
            for t, s, f, u in zip(pdf["term"], pdf["words"], pdf["full"], pdf["uniq"])
        ]
        pdf[["score1", "score2", "score3"]] = pd.DataFrame(scores, index=pdf.index, dtype="int64", columns=["a", "b", "c"])
        yield pdf[["search_name", "names_id", "score1", "score2", "score3"]]


def _sorted_words(text: Column) -> Column:
    """Lower-case ASCII words in alphabetical order."""
    words = F.split(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^A-Za-z0-9]+", " ")), " ")
    return F.array_join(F.array_sort(F.filter(words, lambda w: w != "")), " ")


# Two texts that score 85 or more, whole or in part: one of them leaves at most these shares of its length unmatched in
# letters (2 - 2 / 1.155, if the other is that much shorter), and in pairs of adjacent letters, of which a letter ends two.
_LOST_LETTERS, _LOST_PAIRS = 0.27, 0.54


def _set_of_words(text: Column) -> Column:
    return F.array_join(F.array_distinct(F.split(text, " ")), " ")


def _numbered_letters(text: Column) -> Column:
    """The letters of a text, each with how often it has come up so far: arrays of them intersect as multisets do."""
    sorted_letters = F.array_sort(F.regexp_extract_all(text, F.lit("[^ ]"), F.lit(0)))
    return F.transform(sorted_letters, lambda c, i: F.concat(F.lit("#"), c, (i - F.array_position(sorted_letters, c)).cast("string")))


def _can_reach(one: Column, other: Column) -> Column:
    """Whether one of two texts finds enough of its letters in the other; holds for every pair with the score."""
    def found_in(a: Column, b: Column) -> Column:
        letters = _numbered_letters(_set_of_words(a))
        return F.size(F.array_intersect(letters, _numbered_letters(b))) >= F.size(letters) - F.length(a) * F.lit(_LOST_LETTERS)

    return found_in(one, other) | found_in(other, one)


def _token_candidates(terms: DataFrame, names: DataFrame) -> DataFrame:
    """Pairs (term, names_id) that can reach the threshold.

    Such a pair keeps more than the losable share of the letter pairs inside the words of one of the two texts, so it
    shares one of any larger choice of them. The rarest are chosen, so that a common word or letter pair does not bring
    everybody together. A text with too few letter pairs (short words) looks by the rarest of its numbered letters, by the
    same argument; of a text that repeats words also by those of its set of words.
    """
    def grams(column: str) -> Column:
        return F.concat(F.filter(ngrams(F.col(column), 2), lambda g: ~F.contains(g, F.lit(" "))), _numbered_letters(F.col(column)))

    term_grams = _by_rarity(terms, "term", grams("term"))
    texts = names.select("names_id", F.explode(F.array_distinct(F.array("words", "full", "uniq"))).alias("text")).where("text <> ''")
    text_grams = _by_rarity(texts, "text", grams("text"))

    def marked(mark: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.concat(F.lit(mark), v))

    def rarest(values: Column, text: Column, share: float) -> Column:
        return F.slice(values, F.lit(1), F.floor(F.length(text) * F.lit(share)).cast("int") + 1)

    def keys(name: str, own: str, other: str) -> Column:
        """Keys by which this text looks for others (``own``) and by which others find it (``other``)."""
        every = F.transform("grams", lambda x: x["gram"])
        letters = F.filter(every, lambda g: g.startswith("#"))
        inside = F.filter(every, lambda g: ~g.startswith("#"))
        words = _set_of_words(F.col(name))
        of_set = F.filter(letters, lambda g: F.array_contains(_numbered_letters(words), g))
        by_letters = F.array_union(rarest(letters, F.col(name), _LOST_LETTERS), rarest(of_set, words, _LOST_LETTERS))
        enough = F.size(inside) > F.floor(F.length(name) * F.lit(_LOST_PAIRS))
        return F.concat(marked(own, F.when(enough, rarest(inside, F.col(name), _LOST_PAIRS)).otherwise(by_letters)), marked(other, every))

    asked = term_grams.select("term", F.explode(keys("term", "t:", "n:")).alias("key"))
    offered = text_grams.select("text", F.explode(keys("text", "n:", "t:")).alias("key"))
    found = asked.join(offered, "key").select("term", "text").distinct().where(_can_reach(F.col("term"), F.col("text")))
    return found.join(texts, "text").select("term", "names_id").distinct()


def match_tokens(names: DataFrame, players: DataFrame, threshold: int = 85) -> DataFrame:
    """Players whose names score at least ``threshold`` (85 or more) against each search name.

    Scores: words as sets against all names, and sorted words against the full name in part; if any name is matched
    perfectly (also by the unique name alone), only the first such player by unique name is kept.
    """
    if threshold < 85:
        raise ValueError("candidates are only complete for thresholds of 85 and above")
    terms = names.select("search_name").distinct().withColumn("term", _sorted_words(F.col("search_name"))).where("term <> ''")
    bare = F.trim(F.regexp_replace("unique_name", r"\(.*\)", ""))
    forms = players.select(
        "identifier", "unique_name", _sorted_words(searchable(F.col("name"), F.col("unique_name"), F.col("full_name"))).alias("words"),
        _sorted_words(F.col("full_name")).alias("full"), _sorted_words(bare).alias("uniq"),
    )
    key = F.xxhash64("words", "full", "uniq")
    distinct = forms.select("words", "full", "uniq").distinct().withColumn("names_id", key)
    pairs = _token_candidates(terms, distinct).join(terms, "term").join(distinct, "names_id")
    scored = pairs.select("search_name", "names_id", "term", "words", "full", "uniq").mapInPandas(
        _score_pairs, "search_name string, names_id long, score1 long, score2 long, score3 long"
    )
    best = F.greatest("score1", "score2")
    perfect = F.greatest("score1", "score2", "score3") == 100
    good = scored.where((best >= threshold) | perfect).join(
        forms.withColumn("names_id", key).select("names_id", "identifier", "unique_name"), "names_id"
    ).select("search_name", "identifier", "unique_name", best.alias("score"), perfect.alias("perfect"))
    winners = good.where("perfect").groupBy("search_name").agg(
        F.min(F.struct("unique_name", "identifier", "score")).alias("w")
    )
    others = good.where(~F.col("perfect")).join(winners, "search_name", "left_anti")
    return winners.select("search_name", "w.identifier", "w.unique_name", "w.score").unionByName(
        others.select("search_name", "identifier", "unique_name", "score")
    )

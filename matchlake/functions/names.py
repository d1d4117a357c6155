"""Column expressions for names: short forms, search forms, trigrams and phonetic codes. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchlake.fixed_values import NAME_PARTICLE_PAIRS, NAME_PARTICLES, NICKNAMES


def short_name(full_name: Column, pairs: bool = False) -> Column:
    """First and last word of a name of more than two, with a particle before the last word kept.

    ``pairs`` also keeps two-word particles ("van der").
    """
    words = F.split(full_name, " ")
    first, last, before = F.element_at(words, 1), F.element_at(words, -1), F.element_at(words, -2)
    name = F.when(F.lower(before).isin(NAME_PARTICLES), F.concat_ws(" ", first, before, last))
    if pairs:
        two = F.concat_ws(" ", F.element_at(words, -3), before)
        name = F.when((F.size(words) > 3) & F.lower(two).isin(NAME_PARTICLE_PAIRS), F.concat_ws(" ", first, two, last)).when(
            F.lower(before).isin(NAME_PARTICLES), F.concat_ws(" ", first, before, last)
        )
    return F.when(full_name.isNull() | (F.size(words) <= 2), full_name).otherwise(name.otherwise(F.concat_ws(" ", first, last)))


def searchable(*parts: Column) -> Column:
    """One lower-case search text from several names: no parentheses, each word once, in order of appearance."""
    text = F.lower(F.concat_ws(" ", *[F.trim(F.regexp_replace(p, r"\(.*\)", "")) for p in parts]))
    return F.array_join(F.array_distinct(F.filter(F.split(text, r"\s+"), lambda w: w != "")), " ")


def long_form(name: Column) -> Column:
    """The name with its short first name written out and its second word; NULL where the first word is no short name."""
    words = F.split(F.lower(name), " ")
    known = F.create_map(*[F.lit(x) for pair in NICKNAMES.items() for x in pair])
    long_first = F.try_element_at(known, F.trim(words[0]))
    return F.concat(long_first, F.lit(" "), F.trim(F.coalesce(F.get(words, F.lit(1)), F.lit(""))))


def trigrams(text: Column) -> Column:
    """Distinct trigrams of the lower-case words, each word padded by two blanks before and one after."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    grams = F.transform(
        words,
        lambda w: F.transform(
            F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))
        ),
    )
    return F.array_distinct(F.flatten(grams))


def ngrams(text: Column, size: int) -> Column:
    """Distinct character n-grams of a text as it is; none when it is shorter."""
    last = F.length(text) - size + 1
    starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size))))


def similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct grams."""
    common = F.size(F.array_intersect(a, b))
    return common / F.nullif((F.size(a) + F.size(b) - common), F.lit(0))


def metaphone(text: Column) -> Column:
    """Metaphone code (published rules): what a letter sounds like depends only on the letters around it.

    Written as one expression per position, so distinct names are coded without leaving the JVM.
    """
    start = F.regexp_replace(F.upper(text), "^[^A-Z]+", "")
    padded = F.concat(F.lit("    "), start, F.lit("    "))
    return F.when(
        F.length(start) > 0,
        F.array_join(F.transform(F.sequence(F.lit(1), F.length(start)), lambda i: _sound(padded, i)), ""),
    ).when(text.isNotNull(), "")


def _sound(padded: Column, i: Column) -> Column:
    def at(k: int) -> Column:
        return F.substring(padded, i + 4 + k, F.lit(1))

    def is_in(k: int, letters: str) -> Column:
        return at(k).isin(list(letters))

    silent = F.lit("")
    vowel, soft = "AEIOU", "EIY"
    here = at(0)
    first_of_two = (
        (here == "A") & (at(1) == "E") | is_in(0, "GKP") & (at(1) == "N") | (here == "W") & (is_in(1, "RH") | is_in(1, vowel))
    )
    opening = (
        F.when((here == "A") & (at(1) == "E"), "E")
        .when(is_in(0, "GKP") & (at(1) == "N"), "N")
        .when((here == "W") & (at(1) == "R"), "R")
        .when((here == "W") & (is_in(1, vowel) | (at(1) == "H")), "W")
        .when(here == "X", "S")
        .when(is_in(0, vowel), here)
    )
    swallowed = (
        (at(-1) == "A") & (here == "E") | is_in(-1, "GKP") & (here == "N") | (at(-1) == "W") & (is_in(0, "RH") | is_in(0, vowel))
    )
    sh_before_vowels = (at(1) == "I") & is_in(2, "OA")
    sounds = (
        F.when((here == at(-1)) & (here != "C"), silent)
        .when(here == "B", F.when(at(-1) != "M", "B"))
        .when(
            here == "C",
            F.when((at(-1) == "S") & (at(1) == "H") & (at(2) == "W"), silent)
            .when(is_in(1, soft), F.when((at(1) == "I") & (at(2) == "A"), "X").when(at(-1) == "S", silent).otherwise("S"))
            .when(at(1) == "H", F.when((at(2) == "R") | (at(-1) == "S"), "K").otherwise("X"))
            .otherwise("K"),
        )
        .when(here == "D", F.when((at(1) == "G") & is_in(2, soft), "J").otherwise("T"))
        .when(
            here == "G",
            F.when((at(-1) == "D") & (at(-2) != "D") & is_in(1, soft), silent)
            .when(at(1) == "H", F.when(~(is_in(-3, "BDH") | (at(-4) == "H")), "F").otherwise(silent))
            .when(
                at(1) == "N",
                F.when(~at(2).rlike("[A-Z]") | (at(2) == "E") & (at(3) == "D"), silent).otherwise("K"),
            )
            .when(is_in(1, soft) & (at(-1) != "G"), "J")
            .otherwise("K"),
        )
        .when(here == "H", F.when(is_in(1, vowel) & ~is_in(-1, "CGPST"), "H"))
        .when(here == "K", F.when(at(-1) != "C", "K"))
        .when(here == "P", F.when(at(1) == "H", "F").otherwise("P"))
        .when(here == "Q", "K")
        .when(
            here == "S",
            F.when(sh_before_vowels | (at(1) == "H"), "X")
            .when((at(1) == "C") & (at(2) == "H") & (at(3) == "W"), "X")
            .otherwise("S"),
        )
        .when(
            here == "T",
            F.when(sh_before_vowels, "X").when(at(1) == "H", "0")
            .when((at(1) == "C") & (at(2) == "H"), silent).otherwise("T"),
        )
        .when(here == "V", "F")
        .when(here == "W", F.when(is_in(1, vowel), "W"))
        .when(here == "X", "KS")
        .when(here == "Y", F.when(is_in(1, vowel) & (at(-1) != "C"), "Y"))
        .when(here == "Z", "S")
        .when(is_in(0, "FJLMNR"), here)
    )
    return F.coalesce(
        F.when((i == 1) & (opening.isNotNull() | first_of_two), opening).when((i == 2) & swallowed, silent).otherwise(sounds),
        silent,
    )

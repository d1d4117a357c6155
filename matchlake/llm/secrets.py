"""Secrets in texts: three fixed patterns, and character Markov models of random strings against ordinary identifiers.

Spark expressions only. Positions come from cutting a text at a pattern: the lengths of what stands between the hits and
of the hits themselves add up to where each begins.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions.plan import with_once
from matchlake.llm.columns import set_aside

#: Base patterns, in the order of their kinds. Hits of ``assign`` count when their value has 12 characters or more; the
#: runs of the other two are maximal, so their least length stands in the pattern.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
RUN = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "random")
PATTERNS = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, RUN)))
SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"

#: A run is random when its log-likelihood ratio reaches so many nats in all and per pair of characters.
LEAST_RATIO, LEAST_PER_PAIR = 10.0, 0.6
#: A run of fewer different characters is a rule or a filler, not a secret.
LEAST_KINDS = 8
#: The chance of a character alone weighs as much as so many pairs.
WEIGHT_ALONE = 8.0
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODES = 128


def _value(hit: Column) -> Column:
    """The value of an ``assign`` hit: all behind its first sign, spaces and quote."""
    return F.regexp_extract(hit, r"""[:=]\x20*["']?(.*)$""", 1)


def _pairs(text: Column) -> Column:
    """All pairs of adjacent characters."""
    return F.regexp_extract_all(text, F.lit("(?s)(?=(..))"), F.lit(1))


def learn(docs: DataFrame) -> list[float]:
    """Log-likelihood ratios of character pairs, by 128 times the first character's code plus the second's.

    Labelled samples come from all documents: values that the base patterns find are random strings, and so is the base64 of
    each id's digest; all other words of six characters or more are identifiers. Words are counted first, then their pairs;
    a table of at most 67 x 67 pairs and two classes is fetched. A pair's chance is smoothed by that of its second character alone. Without documents every ratio is 0.
    """
    text = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    digest_of_id = F.base64(F.unhex(F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"), 256)))
    values = F.concat(
        F.filter(F.transform(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(0)), _value), lambda v: F.length(v) >= 12),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)), F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )
    rest = F.regexp_replace("text", f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    samples = text.select(F.lit(1).alias("is_random"), F.explode(F.concat(values, F.array(digest_of_id))).alias("word")).unionByName(
        text.select(F.lit(0).alias("is_random"), F.explode(F.regexp_extract_all(rest, F.lit("[A-Za-z0-9+/_=-]{6,}"), F.lit(0))).alias("word")))
    counted = samples.groupBy("is_random", "word").count().select("is_random", "count", F.explode(_pairs(F.col("word"))).alias("pair"))
    rows = counted.where(F.col("pair").rlike("^[A-Za-z0-9+/_=-]{2}$")).groupBy("is_random", "pair").agg(F.sum("count").alias("n")).collect()
    n, total, single, all_n = {}, {}, {}, {0: 0, 1: 0}
    for r in rows:
        n[r["is_random"], r["pair"]] = r["n"]
        total[r["is_random"], r["pair"][0]] = total.get((r["is_random"], r["pair"][0]), 0) + r["n"]
        single[r["is_random"], r["pair"][1]] = single.get((r["is_random"], r["pair"][1]), 0) + r["n"]
        all_n[r["is_random"]] += r["n"]

    def log_chance(kind: int, a: str, b: str) -> float:
        alone = (single.get((kind, b), 0) + 0.5) / (all_n[kind] + 0.5 * len(_ALPHABET))
        return math.log((n.get((kind, a + b), 0) + WEIGHT_ALONE * alone) / (total.get((kind, a), 0) + WEIGHT_ALONE))

    ratios = [0.0] * (_CODES * _CODES)
    for a in _ALPHABET:
        for b in _ALPHABET:
            ratios[_CODES * ord(a) + ord(b)] = round(log_chance(1, a, b) - log_chance(0, a, b), 6)
    return ratios


def _placed(cut: str, kind: str, good: str) -> Column:
    """The spans of one kind from column ``cut`` (``gaps`` and ``hits``), where ``good`` holds for hit ``h``."""
    return F.expr(f"""aggregate(
        zip_with({cut}.hits, slice({cut}.gaps, 1, size({cut}.hits)), (h, g) -> named_struct('gap', length(g), 'len', length(h), 'good', {good})),
        named_struct('at', 0L, 'spans', cast(array() AS {SPAN})),
        (a, p) -> named_struct('at', a.at + p.gap + p.len, 'spans', if(p.good, concat(a.spans, array(named_struct(
            'start', a.at + p.gap, 'rank', {KINDS.index(kind)}, 'end', a.at + p.gap + p.len, 'kind', '{kind}'))), a.spans)),
        a -> a.spans)""")


def find(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """``docs`` with ``spans``: an array of (start, rank, end, kind) in code points, end exclusive, by start and kind.

    Base spans are leftmost and non-overlapping per kind; kinds may overlap. A ``random`` span is a whole run of 20 characters
    or more that the models call random and that reaches beyond every base span it touches. NULL texts are empty and have no span; repeated
    rows are scanned alike; a column named ``spans`` is replaced, other columns stay.
    """
    text = F.coalesce("text", F.lit(""))
    cuts = [F.struct(F.split(text, p, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias("hits")).alias(k) for k, p in PATTERNS.items()]
    docs, given = set_aside(docs.drop("spans"), ("text",))
    cut = with_once(docs, "_cut", F.struct(*cuts))
    model = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    hit = "regexp_extract(h, '[:=]\\\\x20*[\"\\']?(.*)$', 1)"
    scored = with_once(cut, "_found", F.struct(
        _placed("_cut.assign", "assign", f"length({hit}) >= 12").alias("assign"), _placed("_cut.access", "access", "true").alias("access"),
        _placed("_cut.hex", "hex", "true").alias("hex"), _placed("_cut.random", "random", "true").alias("runs"),
        F.transform("_cut.random.hits", lambda h: F.aggregate(
            _pairs(h), F.lit(0.0), lambda s, p: s + F.get(model, F.ascii(p) * _CODES + F.ascii(F.substring(p, 2, 1))))).alias("ratio"),
        F.transform("_cut.random.hits", lambda h: F.size(F.array_distinct(F.split(h, "")))).alias("kinds"),
    ))
    base = F.concat("_found.assign", "_found.access", "_found.hex")
    chosen = with_once(scored.drop("_cut"), "_base", base)
    judged = F.zip_with(F.arrays_zip("_found.runs", "_found.ratio"), "_found.kinds", lambda r, k: F.struct(
        r["runs"].alias("span"), ((r["ratio"] >= LEAST_RATIO) & (k >= LEAST_KINDS)
                                  & (r["ratio"] >= LEAST_PER_PAIR * (r["runs"]["end"] - r["runs"]["start"] - 1))).alias("good")))
    told = F.filter(F.filter(judged, lambda j: j["good"]), lambda j: ~F.exists("_base", lambda b: (
        (b["start"] <= j["span"]["start"]) & (j["span"]["end"] <= b["end"]))))
    found = with_once(chosen, "spans", F.array_sort(F.concat("_base", F.transform(told, lambda j: j["span"]))))
    return found.select(*given, "spans")


def told(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """``doc_id``, the number of base spans of each kind, a hash of them, and all ``spans`` as text."""
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        F.col("doc_id"), count("assign"), count("access"), count("hex"),
        F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), count("random"), told(F.col("spans")).alias("spans"),
    )


def redact(found: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``found`` without ``spans``, with every run of overlapping spans in ``text`` replaced by ``mark``.

    NULL texts stay NULL; ``n_chars``, where there is such a column, is counted anew for changed texts.
    """
    cuts = F.expr("""aggregate(spans, named_struct('at', 0L, 'gaps', cast(array() AS array<struct<start:bigint,end:bigint>>)),
        (a, s) -> named_struct('at', greatest(a.at, s.end), 'gaps',
            if(s.start < a.at, a.gaps, concat(a.gaps, array(named_struct('start', a.at, 'end', s.start))))),
        a -> concat(a.gaps, array(named_struct('start', a.at, 'end', length(text) + 0L))))""")
    clean = F.array_join(F.transform(cuts, lambda g: F.substr("text", (g["start"] + 1).cast("int"), (g["end"] - g["start"]).cast("int"))), mark)
    held, given = set_aside(found, ("text", "spans", "n_chars"))
    once = with_once(held, "_clean", F.when(F.size("spans") > 0, clean).otherwise(F.col("text")))
    column = {"text": F.col("_clean").alias("text")}
    if "n_chars" in found.columns:
        counted = F.length("_clean").cast(found.schema["n_chars"].dataType)
        column["n_chars"] = F.when(F.size("spans") > 0, counted).otherwise(F.col("n_chars")).alias("n_chars")
    return once.select(*[column.get(c, back) for c, back in zip(found.columns, given) if c != "spans"])

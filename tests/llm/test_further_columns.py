"""Further columns of any name, repeated and missing ids, small languages, and many pieces of one source."""

import random
import time
from collections import Counter

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from matchlake.llm import mixing, packing, quality, secrets

ODD = ["score", "predicted", "spans", "_cut", "_found", "_base", "_clean", "_rate", "_salt", "component_id", "copy", "further_0", "row_key_of_stage"]
TOKEN = "04dbebab91ab85687d33eeaaf9ac699e1188f962"


def odd_docs(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return docs.select("*", *[F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in ODD])


def test_every_stage_keeps_further_columns(spark, tmp_path):
    spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    texts = [f"{'you worthless fool' if i % 3 == 0 else 'a calm garden'} {i} with {i * 7} roses and {i * 3} trees token = {TOKEN}" for i in range(60)]
    docs = odd_docs(spark, [(i, t, "en", "s", len(t or "")) for i, t in enumerate([*texts, None, ""])])
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, now.where("false"), str(tmp_path))
        assert empty.columns == docs.columns and empty.count() == 0, name
        now = stage(spark, now, str(tmp_path)).cache()
        rows = now.collect()
        assert now.columns == docs.columns and rows, name
        assert all(r[c] == f"{c} of {r.doc_id}" for r in rows for c in ODD), name
    assert all(TOKEN not in (r.text or "") for r in rows)
    assert corpus_pipeline.pack_bins(spark, now, str(tmp_path)).count() == len(rows)


def test_operators_keep_further_columns(spark):
    docs = odd_docs(spark, [(i, f"token = {TOKEN} {i}", "en", "s", 1) for i in range(9)]).drop("spans", "copy")
    found = secrets.find(docs, secrets.learn(docs))
    assert found.columns == [*docs.columns, "spans"] and secrets.redact(found).columns == docs.columns
    assert {(r["_cut"], r.text) for r in secrets.redact(found).collect()} == {(f"_cut of {i}", f"[secret] {i}") for i in range(9)}
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "copies", "copy", "shuffle_key"] and all(r["_rate"] == f"_rate of {r.doc_id}" for r in mixed.collect())


def test_rows_that_share_an_id_are_documents_of_their_own(spark, tmp_path):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [(1, long, "en", "s", 1), (1, "quite another text of other words here", "en", "s", 1), (2, long, "en", "s", 1), (None, long + " end", "en", "s", 1),
            (None, "a text without any id at all", "en", "s", 1), (None, "a text without any id at all", None, "s", 1), (7, None, "en", None, 1), (7, None, None, "en", 1),
            (8, "", "en", "s", 1), (8, "", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    results = [sorted(map(tuple, corpus_pipeline.drop_near_duplicates(spark, d, str(tmp_path)).collect()), key=repr) for d in (docs.repartition(4), docs.coalesce(1))]
    assert results[0] == results[1]
    kept = Counter((r[0], r[1]) for r in results[0])
    assert kept == {(1, long): 1, (1, rows[1][1]): 1, (None, "a text without any id at all"): 1, (7, None): 2, (8, ""): 1}


def test_many_pieces_of_one_source_are_packed_fast():
    rng = random.Random(4)
    items = [(rng.randrange(60, 140), None, "hot", k) for k in range(100_000)] + [(rng.randrange(60, 140), f"c{k % 300}", f"s{k % 40}", k) for k in range(20_000)]
    start = time.process_time()
    bins = packing.pack_items(items, packing.CAPACITY, packing.PER_SOURCE)
    assert time.process_time() - start < 60
    assert sorted(k for b in bins for k in b) == list(range(len(items))) and len(bins) == 25_000


def plain_reference(texts, langs, lang):
    """Smoothed shares of common words, counted one by one."""
    words = {l: Counter(w for t, k in zip(texts, langs) if k == l for w in t.lower().split()) for l in set(langs)}
    corpus = sum(words.values(), Counter())
    n, all_n = sum(words[lang].values()), sum(corpus.values())
    share = {w: (words[lang][w] + quality.SMOOTH_WORDS * c / all_n) / (n + quality.SMOOTH_WORDS) for w, c in corpus.items()}
    return {w: s for w, s in share.items() if s >= quality.COMMON_SHARE}


def plain_distance(p, q):
    def part(x):
        return sum(v * np.log2(v / ((p.get(k, 0) + q.get(k, 0)) / 2)) for k, v in x.items() if v > 0)
    return np.sqrt(max(0.0, (part(p) + part(q)) / 2))


def test_every_language_has_a_reference(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choices("the of and to in garden tree house river".split(), k=150)) for _ in range(40)]
    texts += [" ".join(rng.choices("le de et un dans jardin".split(), k=120)) for _ in range(2)] + [" ".join(f"q{rng.randrange(10**9)}#" for _ in range(130))]
    langs = ["en"] * 40 + ["fr"] * 3
    docs = spark.createDataFrame([(i, t, k) for i, (t, k) in enumerate(zip(texts, langs))], "doc_id long, text string, lang string").repartition(3)
    judged = {r.doc_id: r for r in quality.judge(docs, quality.references(docs)).collect()}
    for i, (text, lang) in enumerate(zip(texts, langs)):
        wanted = plain_reference(texts, langs, lang)
        mine, known = Counter(text.split()), {}
        for w, n in mine.items():
            known[w if w in wanted else None] = known.get(w if w in wanted else None, 0) + n / len(text.split())
        assert abs(judged[i].word_distance - plain_distance(known, wanted | {None: 1 - sum(wanted.values())})) < 1e-9
        assert judged[i].char_distance is not None
    assert not judged[42].kept and all(judged[i].kept for i in range(40))

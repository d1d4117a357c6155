"""Operators on whole tables against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import corpus_pipeline
from matchlake.llm import embedding_dedup, mixing, packing, prefix_join

DOCS = "doc_id long, text string, lang string, source string, n_chars long, copy string, component_id string"


def docs_of(spark, texts, source=lambda i: f"s{i % 3}"):
    return spark.createDataFrame([(i, t, "en", source(i), len(t or ""), "x", "y") for i, t in enumerate(texts)], DOCS).repartition(3)


def roots(ids, pairs):
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def some_texts():
    rng = random.Random(3)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 90))] for _ in range(25)]
    texts = [None, "", " \n", "one two", "ONE  two", "a b c d e", "A b c d e"]
    for words in base:
        for _ in range(4):
            changed = list(words)
            for _ in range(rng.randrange(4)):
                changed[rng.randrange(len(changed))] = f"n{rng.randrange(99)}"
            texts.append(" ".join(changed))
    return texts + [texts[20]] * 5 + ["long words in a very long text " * 4000]


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_prefix_join(spark):
    texts = some_texts()
    sets = [shingle_set(t) for t in texts]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    wanted = roots(range(len(sets)), pairs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in prefix_join.near_duplicates(docs_of(spark, texts)).collect()}
    assert got == {i: (len(sets[i]), wanted[i]) for i in wanted}
    assert prefix_join.near_duplicates(docs_of(spark, texts).where("false")).count() == 0


def test_vector_classes(spark):
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(40):
        x = rng.standard_normal(16)
        rows += [(x + 0.05 * rng.standard_normal(16)).tolist() for _ in range(5)]
    rows += [rows[0]] * 6 + [[2 * v for v in rows[0]], None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [1.0, 2.0], [1.0, 2.0]]
    label = [i // 5 % 3 if i < 200 else 0 for i in range(len(rows))]
    label[7] = None
    frame = spark.createDataFrame([(i, v, k, 9) for i, (v, k) in enumerate(zip(rows, label))], "vec_id long, embedding array<float>, label int, n_links int").repartition(3)
    unit = []
    for v, k in zip(rows, label):
        x = np.array(v or [], np.float32).astype(float) if v and None not in v else np.zeros(0)
        ok = k is not None and len(x) and np.isfinite(x).all() and x.any()
        unit.append(x / np.linalg.norm(x) if ok else None)
    pairs = [(a, b) for a in range(len(rows)) for b in range(a)
             if unit[a] is not None and unit[b] is not None and label[a] == label[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98]
    links = Counter(x for p in pairs for x in p)
    wanted = roots(range(len(rows)), pairs)
    # With this many tables no pair is missed; blocks of a few rows cut every bucket.
    embedding_dedup.BLOCK, before = 3, embedding_dedup.BLOCK
    try:
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(frame, recall=1 - 1e-9).collect()}
    finally:
        embedding_dedup.BLOCK = before
    assert got == {i: (links[i], wanted[i], wanted[i] == i) for i in range(len(rows))}
    assert embedding_dedup.near_duplicates(frame.where("false")).count() == 0


def check_packing(rows, texts, sources, capacity, per_source):
    pieces = defaultdict(list)
    bins = defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.copy].append((r.start, r.end))
        bins[r.bin_id].append(r)
    for spans in pieces.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    for held in bins.values():
        assert sum(r.end - r.start for r in held) == held[0].bin_used <= capacity
        assert sorted(r.place for r in held) == list(range(len(held)))
        words = [" ".join(texts[r.doc_id].lower().split()) for r in held if texts[r.doc_id]]
        assert len(words) == len(set(words))
        assert max(Counter(sources(r.doc_id) for r in held).values()) <= per_source
    return pieces


def test_packing(spark):
    texts = some_texts()
    docs = docs_of(spark, texts, lambda i: None if i % 7 == 0 else f"s{i % 3}")
    twice = docs.unionByName(docs.where("doc_id = 3"))
    rows = packing.pack(twice, capacity=1000).collect()
    pieces = check_packing(rows, texts, lambda i: None if i % 7 == 0 else f"s{i % 3}", 1000, packing.PER_SOURCE)
    assert set(pieces) == {(i, 1) for i in range(len(texts))} | {(3, 2)}
    assert all(max(e for _, e in spans) == len(texts[i] or "") for (i, _), spans in pieces.items())
    assert packing.pack(docs.where("false")).count() == 0


def test_packing_takes_the_tightest_bin():
    rng = random.Random(1)
    items = [(rng.randrange(1, 60), rng.choice([None, "a", "b", "c"]), rng.randrange(4), k) for k in range(300)]
    plain = []
    for k in sorted(range(300), key=lambda k: (-items[k][0], items[k][1] or "", items[k][2:])):
        size, cluster, source, _ = items[k]
        fits = [b for b in plain if b["left"] >= size and (cluster is None or cluster not in b["clusters"]) and b["sources"][source] < 2]
        if fits:
            b = min(fits, key=lambda b: (b["left"], b["no"]))
        else:
            b = {"left": 100, "clusters": set(), "sources": Counter(), "no": len(plain), "held": []}
            plain.append(b)
        b["left"] -= size
        b["clusters"].add(cluster)
        b["sources"][source] += 1
        b["held"].append(k)
    assert packing.pack_items(items, 100, 2) == [b["held"] for b in plain]


def test_mixing(spark):
    docs = docs_of(spark, [None, "", *["some text"] * 300], lambda i: None if i < 2 else "big" if i % 10 else "small")
    rows = mixing.mix(docs, {"big": 1.0, "small": 1.0}).collect()
    chars = Counter()
    for r in rows:
        chars[r.source] += len(r.text or "")
    assert set(chars) == {"big", "small"} and 0.6 < chars["small"] / chars["big"] < 1.6
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(docs.repartition(2), {"big": 1.0, "small": 1.0}).collect()))
    assert mixing.mix(docs.where("false")).count() == 0


def test_pipeline(spark, tmp_path):
    calm = [f"a calm text on garden {i} with {i * 7} roses and {i * 3} tall trees near the house {i}" for i in range(120)]
    rude = [f"you worthless fool {i} of garden {i * 5} and {i * 9} trees" for i in range(60)]
    texts = calm + rude + [calm[0] + " now", calm[1], None, "", 'the token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" of ' + "many plain words " * 3]
    docs = docs_of(spark, texts).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i >= 120)) for i in range(180)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path)).cache()
        seen[name] = now.collect()
        if name != "packing":
            assert now.columns == docs.columns
    clean = [i for i in range(len(texts)) if not 120 <= i < 180]
    assert sorted(r.doc_id for r in seen["toxicity"]) == clean
    sets = {i: shingle_set(texts[i]) for i in clean}
    pairs = [(a, b) for a in clean for b in clean if b < a and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert sorted(r.doc_id for r in seen["ngram_join"]) == sorted(i for i, r in roots(clean, pairs).items() if i == r)
    hidden = {r.doc_id: r.text for r in seen["secrets"]}
    assert hidden[184] == "the [secret]\" of " + "many plain words " * 3 and all(hidden[i] == texts[i] for i in hidden if i != 184)
    assert {r.doc_id for r in seen["mixing"]} <= set(hidden) and len(seen["mixing"]) > 0.6 * len(hidden)
    check_packing(seen["packing"], {**dict(enumerate(texts)), **hidden}, lambda i: f"s{i % 3}", packing.CAPACITY, packing.PER_SOURCE)
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(tuple, seen["packing"]))


def test_hash_shape_follows_size():
    planes, tables = embedding_dedup.hash_shape(1 << 30)
    found = 1 - (1 - (1 - math.acos(0.98) / math.pi) ** planes) ** tables
    assert planes == 27 and found >= embedding_dedup.RECALL

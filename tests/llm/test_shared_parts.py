"""Repeated passages, whitened vectors and the prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from matchlake.llm import components, prefix_join, prefix_trie, suffix_buckets, whitening

DOCS = "doc_id long, text string, key string, a string, open string, marks string, n_bytes string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "k", "a", "o", "m", "n") for i, t in rows], DOCS).repartition(3)


def without_repeats(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    starts = defaultdict(set)
    for k, data in enumerate(texts):
        for p in range(len(data) - length + 1):
            starts[data[p : p + length]].add((k, p))
    out = []
    for (doc_id, _), data in zip(rows, texts):
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if len(starts[data[p : p + length]]) > 1:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for p in range(len(data)) if gone[p] and not (p and gone[p - 1]))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def repetitive(seed, length):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 6))) for _ in range(30)]
    passages = [" ".join(rng.choices(words, k=rng.randint(2, 3 + length // 2))) for _ in range(4)]
    rows = [(None, None), (1, ""), (1, "a" * 5 * length), (2, "ab" * 3 * length), (3, passages[0])]
    for i in range(10):
        text = "".join(rng.choice([" ".join(rng.choices(words, k=rng.randint(1, 30))), rng.choice(passages)]) for _ in range(rng.randint(1, 5)))
        rows.append((i + 10, text))
        if i % 4 == 0:
            # Copies under another, the same and no id; a copy with one byte changed.
            rows += [(i + 100, text), (i + 10, text), (None, text), (i + 200, text[: len(text) // 2] + "X" + text[len(text) // 2 + 1 :])]
    return rows


@pytest.mark.parametrize(("seed", "length", "piece"), [(1, 12, 1 << 16), (2, 50, 64), (3, 3, 16)])
def test_repeats(spark, seed, length, piece):
    rows = repetitive(seed, length)
    got = suffix_buckets.remove_repeats(docs_of(spark, rows), length, piece)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == without_repeats(rows, length)


def test_repeats_of_400_bytes(spark):
    rng = random.Random(7)

    def prose(n):
        return "".join(rng.choice("abcdefgh éß") for _ in range(n))

    passage, almost, long = prose(500), prose(380), prose(30000)
    while len(almost.encode()) >= 400:
        almost = almost[:-1]
    rows = [(i, prose(rng.randint(0, 900)) + passage + prose(rng.randint(0, 900))) for i in range(12)]
    rows += [(20 + i, prose(50) + almost + prose(500)) for i in range(4)]
    rows += [(30, long), (31, prose(70) + long[9000:25000] + prose(70)), (32, long[:12000] + passage[100:] + long[12000:]), (33, prose(5000)), (34, None)]
    got = sorted(map(tuple, suffix_buckets.remove_repeats(docs_of(spark, rows)).collect()), key=repr)
    assert got == without_repeats(rows, 400)
    assert suffix_buckets.remove_repeats(docs_of(spark, rows).where("false")).count() == 0


def test_cells_divide_each_other():
    for length in (1, 2, 3, 12, 50, 400, 1000):
        steps = suffix_buckets.widths(length)
        assert steps[0] == length - suffix_buckets.gram_size(length) + 1 and steps[-1] == 1
        assert all(a % b == 0 for a, b in zip(steps[1:], steps[2:]))


def test_secular_update_and_combination():
    rng = np.random.default_rng(4)
    for trial in range(60):
        dim, n = int(rng.integers(1, 30)), int(rng.integers(1, 50))
        x = rng.standard_normal((n, dim)) * rng.choice([1, 1e3])
        if trial % 3 == 0:
            x[:, dim // 2 :] = 0
        if trial % 4 == 0:
            x = np.round(x)
        parts = [whitening.Spectrum(dim) for _ in range(3)]
        for k, row in enumerate(x):
            parts[k % 3].add(row)
        both = whitening.Spectrum.unpacked(parts[0].packed(), dim)
        both.combine(parts[1])
        both.combine(parts[2])
        centred = x - x.mean(axis=0)
        scatter = centred.T @ centred
        assert both.n == n and np.allclose(both.mean, x.mean(axis=0))
        assert np.abs(both.vectors.T @ both.vectors - np.eye(dim)).max() < 1e-12
        assert np.abs(both.vectors * both.values @ both.vectors.T - scatter).max() <= 1e-10 * max(1e-6, np.abs(scatter).max(), n * np.abs(x).max() ** 2 * 1e-6)


VECTORS = "vec_id long, embedding array<float>, x string, component string"


def test_whitening(spark):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((300, 12)) * np.linspace(0.1, 3, 12) + 5
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)] + [(7, vectors[3].tolist()), (None, vectors[3].tolist())]
    odd = [(900, None), (901, []), (902, [None] * 12), (903, [float("nan")] * 12), (904, [float("inf")] + [0.0] * 11), (905, [1.0, 2.0]), (906, [3e38] * 12)]
    frame = spark.createDataFrame([(i, v, "x", "c") for i, v in rows + odd], VECTORS).repartition(20)
    got = whitening.whiten(frame).toPandas()
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    x = np.floor(np.array([v for _, v in rows], np.float32).astype(float) * 1024) + 100000
    n = len(rows)
    centred = x - x.mean(axis=0)
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    assert len(got) == 8 * n and set(got.n) == {n} and got.identity_error.max() < 1e-10
    deviation = {i: int(d) for (i, _), d in zip(rows, (((n * x - x.sum(axis=0)) ** 2).sum(axis=1)))}
    for component in range(8):
        part = got[got.component == component + 1]
        assert np.allclose(part.explained, values[component] / values.sum(), rtol=1e-12)
        wanted = centred @ basis[:, component] / np.sqrt(values[component])
        mine = {i: w for i, w in zip(part.vec_id.astype(object), part.whitened) if i == i and i != 7}
        sign = np.sign(mine[0] * wanted[0])
        assert all(abs(mine[i] * sign - wanted[i]) < 1e-9 for i in range(300) if i != 7)
        assert all(d == deviation[i] for i, d in zip(part.vec_id, part.deviation) if i == i and i != 7)


def test_whitening_of_little(spark):
    none = spark.createDataFrame([(1, None, "x", "c"), (2, [], "x", "c")], VECTORS)
    assert whitening.whiten(none).count() == 0 and whitening.whiten(none.where("false")).count() == 0
    alike = spark.createDataFrame([(1, [1.0, 2.0], "x", "c"), (2, [1.0, 2.0], "x", "c")], VECTORS)
    assert {(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in whitening.whiten(alike).collect()} == {
        (1, 2, 0, None, 0.0, 0.0), (2, 2, 0, None, 0.0, 0.0)}


TURNS = "conv_id long, turn long, role string, text string, digest string, up string, depth string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(role, text) for _, _, role, text in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(int(c / 100) * 100, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def sums(node):
        leaves, saved = (0, 0) if children[node] else (1, 0)
        saved += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        for child in list(children[node]):
            more = sums(child)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    out = []
    for node, convs_in in list(members.items()):
        ends = ",".join(str(c) for c in sorted(convs_in) if len(convs[c]) == len(node))
        out.append((min(convs_in), len(node), min(members[node[:-1]]) if node else None, len(convs_in), len(children[node]), *sums(node),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def some_turns():
    rng = random.Random(11)
    rows = []
    for c in [*range(0, 60), *range(100, 130), -7, -130, 350]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, ["user", "assistant"][t % 2], rng.choice(["hello", "yes é", "no", "what now?", ""])))
    long = [(700 + k, t, "user", f"turn {t}") for k in range(3) for t in range(70)] + [(701, 70, "user", "more")]
    odd = [(5, None, "user", None), (5, None, None, "x"), (5, 1, "user", "tie"), (5, 1, "user", "tie"), (None, 1, "user", "nobody's"), (6, 0, None, None)]
    return rows + long + odd


def run_trie(frame):
    return sorted(map(tuple, prefix_trie.trie(prefix_trie.spliced(prefix_trie.paths(frame))).collect()), key=repr)


@pytest.mark.parametrize("narrow", [False, True])
def test_prefix_trie(spark, narrow, monkeypatch):
    if narrow:
        # A sketch so narrow that it proves next to nothing changes no result; chunks of two ids neither.
        monkeypatch.setattr(prefix_trie, "NARROWEST", 4)
        monkeypatch.setattr(prefix_trie, "WIDEST", 4)
        monkeypatch.setattr(prefix_trie, "CHUNK", 2)
    rows = some_turns()
    frame = spark.createDataFrame([(*r, "d", "u", "x") for r in rows], TURNS).repartition(5)
    assert run_trie(frame) == plain_trie(rebuilt(rows))


def test_prefix_trie_of_little(spark):
    frame = spark.createDataFrame([(3, 0, "user", "only", "d", "u", "x")], TURNS)
    assert run_trie(frame.where("false")) == []
    assert run_trie(frame) == plain_trie(rebuilt([(3, 0, "user", "only")]))


@pytest.mark.parametrize("links", [[], [(2, 1), (1, 2), (5, 1), (7, 7), (None, 3)], [(k, k + 1) for k in range(40)], "random"])
def test_components(spark, links):
    if links == "random":
        draw = random.Random(5)
        links = [(draw.randrange(120), draw.randrange(120)) for _ in range(90)]
    least = {n: n for pair in links if None not in pair and pair[0] != pair[1] for n in pair}
    for _ in least:
        for a, b in links:
            if a in least and b in least:
                least[a] = least[b] = min(least[a], least[b])
    table = spark.createDataFrame(links, "a long, b long")
    assert sorted(map(tuple, components.connected_components(table).collect())) == sorted(least.items())
    assert sorted(map(tuple, components.star_links(table).collect())) == sorted((n, m) for n, m in least.items() if n != m)


def test_settled_links_take_no_round(spark, monkeypatch):
    """Rounds cost the driver a plan of eight stages each; links that are stars are written once, and no round confirms them."""
    written = []
    monkeypatch.setattr(components, "stored", lambda df, keep=components.stored: written.append(1) or keep(df))
    assert components.star_links(spark.createDataFrame([(9, 1), (1, 5), (8, 2)], "a long, b long")).count() == 3
    assert len(written) == 1
    written.clear()
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    texts = [(1, base), (2, base + " more"), (3, "quite another text with other words in it")]
    found = prefix_join.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"))
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(1, 1), (2, 1), (3, 3)]
    assert len(written) == 2

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from matchlake.functions.names import long_form, metaphone, searchable, short_name, trigrams
from matchlake.operators import resolve as rs


def one(spark, column, *values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return [r[0] for r in df.select(column(F.col("t"))).collect()]


def test_short_names(spark):
    names = ["Cher", "Ann Lee", "Ann Mary Lee", "Ann Mary De Wit", "Ann van der Berg", None]
    assert one(spark, short_name, *names) == ["Cher", "Ann Lee", "Ann Lee", "Ann De Wit", "Ann Berg", None]
    assert one(spark, lambda c: short_name(c, pairs=True), "Ann van der Berg", "Ann B De Wit") == ["Ann van der Berg", "Ann De Wit"]


def test_metaphone(spark):
    golden = {
        "GUMBO": "KM", "Knight": "NFT", "Wright": "RFT", "Xavier": "SFR", "Thumb": "0M", "School": "SKL", "Church": "XRX",
        "Edge": "EJ", "Phone": "FN", "Aerial": "ERL", "Virat Kohli": "FRTKL", "Sign": "SN", "Whale": "WL", "Cynthia": "SN0",
        "Nation": "NXN", "Match": "MX", "Schwarz": "XWRS", "Accent": "AKSNT", "": "", None: None,
    }
    assert dict(zip(golden, one(spark, metaphone, *golden))) == golden


def test_trigrams_and_search_text(spark):
    assert sorted(one(spark, trigrams, "Cat, a")[0]) == sorted(["  c", " ca", "cat", "at ", "  a", " a "])
    assert one(spark, lambda c: searchable(c, c), "V Kohli (2) x")[0] == "v kohli x"
    assert one(spark, long_form, "Mike Hussey", "Ann Lee", "sam") == ["michael hussey", None, "samuel "]


@pytest.fixture(scope="module")
def players(spark):
    data = [
        ("p3", "MEK Hussey", "MEK Hussey", "Michael Edward Hussey", "Michael Hussey"),
        ("p2", "J Smith", "J Smith (2)", "John Smith", "John Smith"), ("p1", "J Smith", "J Smith", "John A Smith", "John Smith"),
        ("p4", "V Kohli", "V Kohli", "Virat Kohli", "Virat Kohli"), ("p5", "R Nobody", "R Nobody", None, None),
    ]
    return spark.createDataFrame(data, "identifier string, name string, unique_name string, full_name string, first_last_name string")


def test_resolution(spark, players):
    asked = ["Mike Hussey", "v kohli", "john smith", "Virath Koli", "Zzyzx Qwrt", "J Smith (2)"]
    names = spark.createDataFrame([(a,) for a in asked], "search_name string")
    assert rows(rs.resolve_names(names, players)) == sorted([
        ("Mike Hussey", "p3", "exact"), ("v kohli", "p4", "exact"), ("john smith", "p1", "exact"), ("Virath Koli", "p4", "fuzzy"),
        ("Zzyzx Qwrt", None, None), ("J Smith (2)", "p2", "exact")], key=repr)
    hit = rs.match_exact(rs.variants(names), players).where("search_name = 'john smith'").first()
    assert (hit.level, hit.n_candidates) == (1, 2)


def test_popularity_accepts_contained_codes(spark, players):
    names = rs.variants(spark.createDataFrame([("Vir",)], "search_name string"))
    assert rows(rs.match_fuzzy(names, players), "identifier") == []
    fame = spark.createDataFrame([("p4", 5)], "identifier string, popularity int")
    assert rows(rs.match_fuzzy(names, players, popularity=fame), "identifier") == [("p4",)]


def test_aliases(spark, players):
    names = spark.createDataFrame([("J Smith",), ("p4",), ("J Smith (2)",), ("who",)], "name string")
    want = {("J Smith", "p1"), ("J Smith (2)", "p2"), ("p4", "p4"), ("who", None)}
    assert set(rows(rs.resolve_alias(names, players))) == want
    assert set(rows(rs.resolve_alias(names, players, "identifier_first"))) == want


def grams(text):
    return {f"  {w} "[i:i + 3] for w in text.split() for i in range(len(w) + 1)}


@pytest.mark.parametrize("common", [0, 3, 1000])
@pytest.mark.parametrize("min_sim", [0.3, 0.5])
def test_trigram_join_finds_every_pair(spark, common, min_sim):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    names = sorted({" ".join(rnd.sample(words, rnd.randint(1, 2))) for _ in range(90)} | {"a", "b", "ab"})
    left, right = names[::2], names[1::2] + names[:5]
    want = {
        (a, b) for a in left for b in right
        if len(grams(a) & grams(b)) / len(grams(a) | grams(b)) >= min_sim - 1e-9
    }
    df = lambda v, c: spark.createDataFrame([(x,) for x in v], f"{c} string")
    got = rs.trigram_join(df(left, "a"), df(right, "b"), "a", "b", min_sim, common).collect()
    assert len(got) == len(want) and {(r.a, r.b) for r in got} == want


def test_token_match_equals_brute_force(spark):
    rnd = random.Random(11)
    first, last = ["virat", "sachin", "ravi", "suresh", "ann", "jo"], ["kohli", "tendulkar", "raina", "jadeja", "li", "smithson"]
    people = [(f"i{k:03d}", f"{a[0]} {b}", f"{a[0]} {b}" + (" (2)" if k % 5 == 0 else ""), f"{a} {m}{b}".strip())
              for k, (a, b, m) in enumerate((a, b, m) for a in first for b in last for m in ("", "kumar "))]
    full = [f"{a} {b}" for a in first for b in last]
    terms = sorted({t[:i] + t[i + 1:] for t in full for i in rnd.sample(range(len(t)), 2)} | {"sachin", "raina", "kohli virat"})

    def words(t):
        return " ".join(sorted("".join(c if c.isalnum() else " " for c in t.lower()).split()))

    want = set()
    for term in terms:
        scored = []
        for pid, name, unique, fullname in people:
            bare = unique.replace(" (2)", "")
            parts = list(dict.fromkeys(f"{name} {bare} {fullname}".lower().split()))
            s1 = rs._token_set(words(term), words(" ".join(parts)))
            s2, s3 = rs._partial(words(term), words(fullname)), rs._partial(words(term), words(bare))
            if max(s1, s2) >= 85 or max(s1, s2, s3) == 100:
                scored.append((max(s1, s2, s3) == 100, unique, pid, max(s1, s2)))
        perfect = sorted((u, p, s) for ok, u, p, s in scored if ok)
        want |= {(term, perfect[0][1])} if perfect else {(term, p) for _, _, p, _ in scored}
    players = spark.createDataFrame(people, "identifier string, name string, unique_name string, full_name string")
    got = rs.match_tokens(spark.createDataFrame([(t,) for t in terms], "search_name string"), players)
    assert {(r.search_name, r.identifier) for r in got.collect()} == want
    with pytest.raises(ValueError):
        rs.match_tokens(players, players, 50)


def test_token_match_of_short_words(spark):
    rnd = random.Random(7)
    full = ["ab cd ef gh", "a b c d e", "a", "aa aa aa b", "x yz x yz x yz q", "li wu"] + [
        " ".join("".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 3))) for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    terms = {"axb cxd exf gxh", "a b c d", "a a a a b", "x yz q"}
    for t in full:
        k = rnd.randrange(len(t) + 1)
        terms |= {t[:k] + rnd.choice("abx ") + t[k:], t[:k] + t[k + 1:], t}

    def words(t):
        return " ".join(sorted(t.lower().split()))

    terms = sorted(t for t in terms if words(t))
    people = [(k, words(" ".join(dict.fromkeys(t.split()))), words(t), words(t)) for k, t in enumerate(full)]
    want = {
        (words(t), k) for t in terms for k, unique_words, name, _ in people
        if max(rs._token_set(words(t), unique_words), rs._partial(words(t), name)) >= 85
    }
    names = spark.createDataFrame(people, "names_id long, words string, full string, uniq string")
    got = rs._token_candidates(spark.createDataFrame([(words(t),) for t in terms], "term string"), names).collect()
    assert (words("axb cxd exf gxh"), 0) in want
    assert want - {(r.term, r.names_id) for r in got} == set()
    player = spark.createDataFrame([("p", "ab cd ef gh", "ab cd ef gh", "ab cd ef gh")], "identifier string, name string, unique_name string, full_name string")
    found = rs.match_tokens(spark.createDataFrame([("axb cxd exf gxh",)], "search_name string"), player)
    assert rows(found, "identifier", "score") == [("p", 85)]

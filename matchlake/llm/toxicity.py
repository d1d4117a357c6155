"""Toxicity: a logistic classifier over words, regularised by counterfactuals.

Labelled texts are learned from by the set of their words and of the beginnings of these, since one insult comes with many
endings. Where a text names a group, the same text with the group's
term swapped for every other of its kind is a counterfactual, and training penalises the squared change of the text's
logit, so that naming a group does not move a score by itself. Words that toxic and other texts hold alike are screened out
first, and a lasso penalty leaves of the others only what matters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm import shingles
from matchlake.llm.storing import stored

#: About so many labelled documents are learned from at most, picked by a hash of their id.
LEARNED_DOCS = 6000
#: Terms for groups of people, by kind; one is swapped for the others of its kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "trans", "queer"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab", "african"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("disabled", "blind", "deaf", "autistic"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)
LASSO = 0.0005
COUNTERFACTUAL = 1.0
LEAST_DOCS = 3
#: A word goes on if its toxic texts are so many standard deviations from what chance gives.
LEAST_DEVIATION = 3.0
STEPS = 300
#: Beginnings of so many bytes stand for a longer word beside the word itself.
BEGINNINGS = (4, 5, 6, 7, 8)


def _word_sets(texts: pa.Array):
    """Of runs of rows: first and last row, and their distinct words and beginnings as parallel arrays (row, hash)."""
    for first, last, data, offsets in shingles.slices(texts):
        letter = (data >= 128) | ((data >= 48) & (data <= 57)) | ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122))
        plain = np.where(letter, data, np.uint8(32))
        row, starts, ends = shingles.words(plain, offsets)
        rows, tokens = [row], [shingles.word_hashes(plain, starts, ends)]
        for size in BEGINNINGS:
            longer = ends - starts > size
            rows.append(row[longer])
            tokens.append(shingles.word_hashes(plain, starts[longer], starts[longer] + size) ^ np.uint64(size))
        row, token = np.concatenate(rows), np.concatenate(tokens)
        order = np.lexsort((token, row))
        row, token = row[order], token[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (token[1:] != token[:-1])
        yield first, last, row[new], token[new]


def _identity_hashes() -> tuple[list[np.ndarray], np.ndarray]:
    """The hash of each term, by kind, and the hashes of the terms' beginnings."""
    kinds, beginnings = [], [np.zeros(0, np.uint64)]
    for kind in IDENTITY_TERMS:
        own = []
        for _, _, _, token in _word_sets(pa.array(kind)):
            datas = [np.frombuffer(w.encode(), np.uint8) for w in kind]
            own = np.array([shingles.word_hashes(d, np.array([0]), np.array([len(d)]))[0] for d in datas], np.uint64)
            beginnings.append(np.setdiff1d(token, own))
        kinds.append(own)
    return kinds, np.concatenate(beginnings)


def labelled_sample(docs: DataFrame, labels: DataFrame, may_learn: Column, learned_docs: int = LEARNED_DOCS) -> DataFrame:
    """``doc_id``, ``toxic`` and ``words`` (hashes of a text's distinct words) of about ``learned_docs`` labelled documents.

    A document labelled more than once counts as toxic if one label says so; NULL labels and ids do not count.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, learned_docs / max(1, known.where(may_learn).count()))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = known.where(may_learn & (draw < share))

    def sets(batches):
        for batch in batches:
            for first, last, row, token in _word_sets(batch.column(2)):
                begin = np.searchsorted(row, np.arange(last - first + 1))
                blobs = [token[b:e].tobytes() for b, e in zip(begin[:-1], begin[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first), pa.array(blobs, pa.binary())],
                    ["doc_id", "toxic", "words"])

    # The sample is bounded, so it may be sent to the texts.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(picked.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")), "doc_id").select("doc_id", "toxic", "text")
    # Rows that repeat a document count once.
    return texts.mapInArrow(sets, "doc_id long, toxic int, words binary").groupBy("doc_id", "toxic").agg(F.max("words").alias("words"))


def vocabulary(sample: DataFrame) -> np.ndarray:
    """Hashes, sorted, of the words and beginnings that toxic and other texts of ``sample`` do not hold alike, and of all
    identity terms. Tasks count; only what passes is fetched."""
    def count(batches):
        for batch in batches:
            blobs = [np.frombuffer(b.as_buffer(), np.uint64) for b in batch.column(1)]
            token, at, n = np.unique(np.concatenate(blobs), return_inverse=True, return_counts=True)
            toxic = np.bincount(at, np.repeat(batch.column(0).to_numpy(), [len(b) for b in blobs]), minlength=len(token))
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(toxic.astype(np.int64))], ["token", "n", "toxic"])

    kinds, beginnings = _identity_hashes()
    totals = sample.agg(F.count("*").alias("docs"), F.avg("toxic").alias("rate")).first()
    if not totals["docs"]:
        return np.zeros(0, np.uint64)
    counted = sample.select("toxic", "words").mapInArrow(count, "token long, n long, toxic long").groupBy("token").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    rate = F.lit(totals["rate"])
    told = (F.col("n") >= LEAST_DOCS) & (F.abs(F.col("toxic") - F.col("n") * rate) >= LEAST_DEVIATION * F.sqrt(F.col("n") * rate * (1 - rate)))
    words = counted.where(told).select("token").toArrow().column(0).to_numpy().view(np.uint64)
    # A term counts as a whole word only, or its beginnings would keep what a swap takes out. Terms are features even where
    # they are rare, so that a swap to a term never seen is felt.
    return np.union1d(np.setdiff1d(words, beginnings), np.concatenate(kinds))


def fit(sample: DataFrame, lasso: float = LASSO, counterfactual: float = COUNTERFACTUAL, steps: int = STEPS) -> dict:
    """Words with a weight (sorted hashes), their weights, and the bias; fitted on the bounded sample by accelerated
    proximal gradient steps. Without labelled rows there is no word, and every score is 0."""
    sample = stored(sample)
    words = vocabulary(sample)
    if not len(words):
        return {"words": words, "weights": np.zeros(0), "bias": -np.inf}

    def features(batches):
        for batch in batches:
            held = [np.flatnonzero(np.isin(words, np.frombuffer(b.as_buffer(), np.uint64))).astype(np.int32) for b in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(held, pa.list_(pa.int32()))], ["doc_id", "toxic", "held"])

    table = sample.select("doc_id", "toxic", "words").mapInArrow(features, "doc_id long, toxic int, held array<int>").orderBy("doc_id", "toxic").toArrow().combine_chunks()
    y = table.column("toxic").to_numpy().astype(np.float64)
    held = table.column("held").combine_chunks()
    row = np.repeat(np.arange(len(held)), pc.list_value_length(held).to_numpy())
    col = held.flatten().to_numpy().astype(np.int64)
    kinds, _ = _identity_hashes()

    # A swap takes one term out and puts another in.
    out_term, in_term = [], []
    for terms in kinds:
        places = np.searchsorted(words, terms)
        some = np.isin(col, places)
        present = np.sort(row[some] * len(words) + col[some])
        for a in places:
            mine = np.unique(row[col == a])
            new = (places[None, :] != a) & ~np.isin(mine[:, None] * len(words) + places[None, :], present)
            out_term.append(np.full(int(new.sum()), a, np.int64))
            in_term.append(np.broadcast_to(places, new.shape)[new])
    out_term, in_term = np.concatenate(out_term), np.concatenate(in_term)

    docs, width = len(y), len(words)
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    w, bias = np.zeros(width), np.log(rate / (1 - rate))
    v, v_bias, t = w.copy(), bias, 1.0
    # The step length follows from the features' curvature, found by power iteration.
    x, curve = np.ones(width) / np.sqrt(width), 0.0
    for _ in range(30):
        z = np.bincount(col, np.bincount(row, x[col], minlength=docs)[row], minlength=width)
        curve = float(np.linalg.norm(z))
        if curve == 0:
            break
        x = z / curve
    swaps = max(1, len(out_term))
    step = 1.0 / (0.3 * (curve / docs + 1.0) + 4.0 * counterfactual * (np.bincount(out_term, minlength=1).max(initial=0) + np.bincount(in_term, minlength=1).max(initial=0)) / swaps + 1e-9)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(np.bincount(row, v[col], minlength=docs) + v_bias, -50, 50)))
        gap = (p - y) / docs
        grad = np.bincount(col, gap[row], minlength=width)
        if len(out_term):
            change = 2.0 * counterfactual * (v[in_term] - v[out_term]) / swaps
            grad += np.bincount(in_term, change, minlength=width) - np.bincount(out_term, change, minlength=width)
        moved = v - step * grad
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * lasso, 0.0)
        new_bias = v_bias - step * gap.sum()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, v_bias = new + (t - 1) / t_new * (new - w), new_bias + (t - 1) / t_new * (new_bias - bias)
        w, bias, t = new, new_bias, t_new
    some = w != 0
    return {"words": words[some], "weights": w[some], "bias": float(bias)}


def score(docs: DataFrame, model: dict, *carried: str) -> DataFrame:
    """``doc_id``, the columns ``carried``, ``score`` and ``predicted`` (1 from a score of 0.5 on) for every row.

    Only ``text`` is looked at, whole; NULL and empty texts get the score of no words. Repeated rows score alike, no rows give
    none. Carried columns named ``score`` or ``predicted`` give way to those made here.
    """
    carried = tuple(c for c in carried if c.lower() not in ("doc_id", "score", "predicted"))
    words, weights, bias = model["words"], model["weights"], model["bias"]
    schema = docs.select("doc_id", *carried).schema
    told = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema] + ["score double", "predicted int"])

    def judge(batches):
        for batch in batches:
            for first, last, row, token in _word_sets(batch.column(0)):
                logit = np.full(last - first, bias)
                if len(words) and len(token):
                    at = np.minimum(np.searchsorted(words, token), len(words) - 1)
                    logit += np.bincount(row, np.where(words[at] == token, weights[at], 0.0), minlength=last - first)
                chance = np.where(np.isneginf(logit), 0.0, 1.0 / (1.0 + np.exp(-np.clip(logit, -500, 500))))
                kept = [batch.column(k).slice(first, last - first) for k in range(1, batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(chance), pa.array((chance >= 0.5).astype(np.int32))], [*schema.names, "score", "predicted"])

    return docs.select("text", "doc_id", *carried).mapInArrow(judge, told)

"""Language identification by prediction by partial matching over bytes.

Every language has a context tree of order 3: how often each byte followed each of the last three, two, one and no bytes
in its training texts. A text's exact code length under a language is the sum over its bytes of the bits its tree gives:
the byte's own share in the longest context that has been seen, or an escape and the next shorter context, down to one
byte in 256. Escapes follow method C (as many as the context has different successors). The statistics are frozen, so
texts are scored independently, and the bits of every byte sequence seen in training are worked out beforehand.

Texts are compared in lower case.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm import shingles

#: About so many documents of each language are learned from, picked by a hash of their id; whole texts of each.
LEARNED_DOCS = 1000
UNKNOWN = "und"


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte the last three bytes of its text and itself as a number; zeros stand before a text's first byte."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.arange(len(data)) + 3 * (row + 1)
    padded = np.zeros(len(data) + 3 * (len(offsets) - 1) + 3, np.uint32)
    padded[at] = data
    return (padded[at - 3] << np.uint32(24)) | (padded[at - 2] << np.uint32(16)) | (padded[at - 1] << np.uint32(8)) | padded[at]


def _lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))


def count_grams(learned: DataFrame) -> DataFrame:
    """``lang``, ``gram``, ``n``: how often each byte followed three others, over whole texts."""

    def count(batches):
        for batch in batches:
            for lang in pc.unique(batch.column(0)).to_pylist():
                texts = batch.column(1).filter(pc.equal(batch.column(0), lang))
                held = [_grams(data, offsets) for _, _, data, offsets in shingles.slices(_lowered(texts))]
                gram, n = np.unique(np.concatenate(held), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    return learned.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def sample_of_languages(docs: DataFrame, may_learn: Column, per_language: int = LEARNED_DOCS) -> DataFrame:
    """Rows with text and language that ``may_learn`` allows; of each language about ``per_language`` at most, by hashed id."""
    labelled = docs.where(may_learn & F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN)).select("doc_id", "lang", "text")
    shares = {r["lang"]: min(1.0, per_language / r["count"]) for r in labelled.groupBy("lang").count().collect()}
    if not shares:
        return labelled.where("false")
    share = F.create_map(*[F.lit(x) for pair in sorted(shares.items()) for x in pair])[F.col("lang")]
    draw = F.pmod(F.xxhash64("doc_id", F.lit("languages")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return labelled.where(draw < share)


def context_trees(counts: DataFrame) -> dict:
    """The frozen statistics as arrays: bits of known four- and three-byte sequences, escapes and shorter contexts.

    The table of grams is as large as the learned sample allows, not as the corpus.
    """
    table = counts.toArrow()
    langs = sorted(set(table.column("lang").to_pylist()))
    if not langs:
        return {"langs": langs}
    place = {lang: i for i, lang in enumerate(langs)}
    lang_of = np.array([place[x] for x in table.column("lang").to_pylist()], np.int64)
    gram, n = table.column("gram").to_numpy().astype(np.uint32), table.column("n").to_numpy().astype(np.float64)
    width = len(langs)

    def totals(keys: np.ndarray, into: np.ndarray) -> np.ndarray:
        """Counts by key and language."""
        at = np.searchsorted(into, keys) * width + lang_of
        return np.bincount(at, n, minlength=len(into) * width).reshape(len(into), width)

    known4, known3 = np.unique(gram), np.unique(np.concatenate([gram >> np.uint32(8), gram & np.uint32(0xFFFFFF)]))
    pairs, singles = np.arange(1 << 16, dtype=np.uint32), np.arange(256, dtype=np.uint32)
    count4, count3 = totals(gram, known4), totals(gram & np.uint32(0xFFFFFF), known3)
    count2, count1 = totals(gram & np.uint32(0xFFFF), pairs), totals(gram & np.uint32(0xFF), singles)

    def own_and_escape(count: np.ndarray, context: np.ndarray, contexts: int) -> tuple[np.ndarray, np.ndarray]:
        """Bits of the byte where its context has it (infinite where not), and bits of an escape (0 for an unseen context)."""
        seen = np.stack([np.bincount(context, count[:, i], minlength=contexts) for i in range(width)], 1)
        kinds = np.stack([np.bincount(context, count[:, i] > 0, minlength=contexts) for i in range(width)], 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            own = -np.log2(count / (seen + kinds)[context])
            escape = np.where(seen > 0, -np.log2(kinds / (seen + kinds)), 0.0)
        return np.where(count > 0, own, np.inf), escape

    own1, escape1 = own_and_escape(count1, np.zeros(256, np.int64), 1)
    bits1 = np.where(np.isfinite(own1), own1, escape1[0] + 8.0)
    own2, escape2 = own_and_escape(count2, (pairs >> np.uint32(8)).astype(np.int64), 256)
    bits2 = np.where(np.isfinite(own2), own2, escape2[pairs >> np.uint32(8)] + bits1[pairs & np.uint32(0xFF)])
    own3, escape3 = own_and_escape(count3, (known3 >> np.uint32(8)).astype(np.int64), 1 << 16)
    bits3 = np.where(np.isfinite(own3), own3, escape3[known3 >> np.uint32(8)] + bits2[known3 & np.uint32(0xFFFF)])
    # Every context of three bytes and every last three bytes of a known sequence are among the known threes.
    context4 = np.searchsorted(known3, known4 >> np.uint32(8))
    own4, escape4 = own_and_escape(count4, context4, len(known3))
    bits4 = np.where(np.isfinite(own4), own4, escape4[context4] + bits3[np.searchsorted(known3, known4 & np.uint32(0xFFFFFF))])
    small = {name: a.astype(np.float32) for name, a in {"bits4": bits4, "bits3": bits3, "bits2": bits2, "escape4": escape4, "escape3": escape3}.items()}
    return {"langs": langs, "known4": known4, "known3": known3, **small}


def _find(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


def code_lengths(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each text (rows) under each language (columns)."""
    gram = _grams(data, offsets)
    at, found = _find(model["known4"], gram)
    bits = model["bits4"][at]
    lost = np.flatnonzero(~found)
    if len(lost):
        rest = gram[lost]
        context, seen = _find(model["known3"], rest >> np.uint32(8))
        escape = np.where(seen[:, None], model["escape4"][context], np.float32(0))
        last, known = _find(model["known3"], rest & np.uint32(0xFFFFFF))
        shorter = model["escape3"][(rest >> np.uint32(8)) & np.uint32(0xFFFF)] + model["bits2"][rest & np.uint32(0xFFFF)]
        bits[lost] = escape + np.where(known[:, None], model["bits3"][last], shorter)
    # A row of zeros behind the last text keeps empty texts at the end in bounds.
    bits = np.concatenate([bits, np.zeros((1, bits.shape[1]), np.float32)])
    summed = np.add.reduceat(bits, offsets[:-1], axis=0, dtype=np.float64)
    summed[np.diff(offsets) == 0] = 0.0
    return summed


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``bits_per_byte`` (of the language predicted) for every row.

    The score is the predicted language's share when each language's chance is two to the minus code length. Texts that
    are NULL or have no letter, and all texts when nothing was learned, are ``und`` with score 0. Of equal code lengths the
    first language in alphabetical order wins. Only ``text`` is looked at; rows that repeat are scored alike.
    """
    langs = model["langs"]

    def score(batches):
        for batch in batches:
            lettered = pc.fill_null(pc.match_substring_regex(batch.column(1), r"\p{L}"), False)
            for first, last, data, offsets in shingles.slices(_lowered(batch.column(1))):
                letters = lettered.slice(first, last - first).to_numpy(zero_copy_only=False)
                n = last - first
                name, share, per_byte = [UNKNOWN] * n, np.zeros(n), np.zeros(n)
                if langs and letters.any():
                    bits = code_lengths(model, data, offsets)
                    best = bits.argmin(1)
                    least = bits[np.arange(n), best]
                    chance = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(1)
                    share = np.where(letters, chance, 0.0)
                    per_byte = np.where(letters, least / np.maximum(np.diff(offsets), 1), 0.0)
                    name = [langs[b] if k else UNKNOWN for b, k in zip(best, letters)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(name, pa.string()), pa.array(share), pa.array(per_byte)],
                    ["doc_id", "lang_pred", "score", "bits_per_byte"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, lang_pred string, score double, bits_per_byte double")


def identify(docs: DataFrame, may_learn: Column, per_language: int = LEARNED_DOCS) -> DataFrame:
    """Learn from the rows of ``docs`` that ``may_learn`` allows and predict all of them; see ``predict``.

    Needs ``doc_id``, ``text`` and ``lang``; other columns are ignored.
    """
    return predict(docs, context_trees(count_grams(sample_of_languages(docs, may_learn, per_language))))

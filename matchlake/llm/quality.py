"""Quality rules by distribution divergence.

Each language has two reference histograms, counted over all its documents: character classes, and common words (each that
makes up at least ``COMMON_SHARE`` of the language's words, the rest as one bin). Shares of a language are smoothed toward those of
all documents, as if so many words and code points of the whole corpus were added to it; that says little in a large language
and much in one of a few short texts, and every language has a reference. A document is compared with its language's references by the Jensen-Shannon distance (base 2, so from 0 to 1). Short texts scatter widely by chance, so each of the two
comparisons only counts from a least length on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm import shingles
from matchlake.llm.storing import stored

COMMON_SHARE = 0.004
#: Words and code points of the whole corpus that are added to each language.
SMOOTH_WORDS, SMOOTH_CHARS = 100.0, 1000.0
LEAST_CHARS, LEAST_WORDS = 200, 100
FARTHEST_CHARS, FARTHEST_WORDS = 0.25, 0.33
WINDOW = 5
FEWEST_WORDS = 10
CLASSES = 8
FLUSH_WORDS = 1 << 20


def _class_table() -> np.ndarray:
    """Class of each byte: small, capital, digit, space, line end, point, other sign, beyond ASCII; -1 within a code point."""
    table = np.full(256, 6, np.int64)
    table[97:123], table[65:91], table[48:58], table[32], table[192:] = 0, 1, 2, 3, 7
    table[9:14] = 4
    for b in b".,;:!?'\"()-":
        table[b] = 5
    table[128:192] = -1
    return table


_CLASS = _class_table()
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))


def _class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points of each class, one row per text."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    kind = _CLASS[data]
    return np.bincount(row[kind >= 0] * CLASSES + kind[kind >= 0], minlength=(len(offsets) - 1) * CLASSES).reshape(-1, CLASSES)


def references(docs: DataFrame) -> dict:
    """By language: ``classes`` (shares), ``words`` (sorted hashes of common words), ``shares`` (of these, then of the rest).

    All documents are counted. Tasks add up their words before they are shuffled; what is fetched is bounded by the number
    of languages, since at most 1 / ``COMMON_SHARE`` words of each, and of the corpus, can be common. NULL languages are one language.
    No rows give no references.
    """
    schema = "lang string, kind int, token long, n long"

    def count(batches):
        held: dict = {}
        many = 0

        def flush():
            for lang, (tokens, classes) in held.items():
                token, n = np.unique(np.concatenate(tokens), return_counts=True) if tokens else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                kind = np.concatenate([np.zeros(len(token), np.int32), np.ones(CLASSES, np.int32), np.full(1, 2, np.int32)])
                all_tokens = np.concatenate([token.view(np.int64), np.arange(CLASSES), [0]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(kind), pa.string()), pa.array(kind), pa.array(all_tokens), pa.array(np.concatenate([n, classes, [n.sum()]]).astype(np.int64))],
                    ["lang", "kind", "token", "n"])

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for first, last, data, offsets in shingles.slices(batch.column(1)):
                row, starts, ends = shingles.words(data, offsets)
                token, classes = shingles.word_hashes(data, starts, ends), _class_counts(data, offsets)
                of_row = np.array(langs[first:last], object)
                for lang in set(of_row.tolist()):
                    mine = np.array([x == lang for x in of_row])
                    tokens, so_far = held.get(lang, ([], np.zeros(CLASSES, np.int64)))
                    tokens.append(token[mine[row]])
                    held[lang] = tokens, so_far + classes[mine].sum(0)
                many += len(token)
            if many >= FLUSH_WORDS:
                yield from flush()
                held, many = {}, 0
        yield from flush()

    counted = docs.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(count, schema).groupBy("lang", "kind", "token").agg(F.sum("n").alias("n"))
    counts = stored(counted)
    corpus = counts.groupBy("kind", "token").agg(F.sum("n").alias("corpus_n"))
    words = {r["lang"]: r["n"] for r in counts.where("kind = 2").collect()}
    corpus_words = max(1, sum(words.values()))
    classes = {lang: np.zeros(CLASSES) for lang in words}
    for r in counts.where("kind = 1").collect():
        classes[r["lang"]][r["token"]] = r["n"]
    corpus_classes = sum(classes.values(), np.zeros(CLASSES))
    corpus_classes = corpus_classes / max(1.0, corpus_classes.sum())
    # Words whose smoothed share reaches the least one either do so in the corpus or have more than that in the language.
    everywhere = {r["token"]: r["corpus_n"] / corpus_words for r in corpus.where(
        (F.col("kind") == 0) & (F.col("corpus_n") >= corpus_words * COMMON_SHARE)).collect()}
    total = counts.where("kind = 2").select(F.col("lang").alias("of"), F.col("n").alias("all_n"))
    own = counts.where("kind = 0").join(total, F.col("lang").eqNullSafe(F.col("of")))
    frequent = own.where((F.col("n") >= F.col("all_n") * COMMON_SHARE) | F.col("token").isin(list(everywhere)))
    found: dict = {lang: {} for lang in words}
    for r in frequent.join(corpus.where("kind = 0").select("token", "corpus_n"), "token").select("lang", "token", "n", "corpus_n").collect():
        found[r["lang"]][r["token"]] = r["n"], r["corpus_n"] / corpus_words
    made = {}
    for lang, n in words.items():
        candidates = {token: (0, share) for token, share in everywhere.items()} | found[lang]
        smoothed = {token: (k + SMOOTH_WORDS * share) / (n + SMOOTH_WORDS) for token, (k, share) in candidates.items()}
        common = sorted((token for token, share in smoothed.items() if share >= COMMON_SHARE), key=lambda token: token & (2**64 - 1))
        shares = np.array([smoothed[token] for token in common])
        chars = classes[lang] + SMOOTH_CHARS * corpus_classes
        made[lang] = {
            "classes": chars / max(1.0, chars.sum()), "words": np.array(common, np.int64).view(np.uint64), "shares": np.append(shares, 1.0 - shares.sum()),
        }
    return made


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of shares ``p`` from ``q``."""
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0.0).sum(-1)
        right = np.where(q > 0, q * np.log2(q / middle), 0.0).sum(-1)
    return np.sqrt(np.clip((left + right) / 2, 0.0, 1.0))


def _lines(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per text, the lines with a word that equal an earlier line of it."""
    cut = data == 10
    begins = np.concatenate([offsets[:-1], np.flatnonzero(cut) + 1])
    ends = np.concatenate([offsets[1:], np.flatnonzero(cut)])
    begins, ends = np.sort(begins), np.sort(ends)
    # A line feed at a text's end opens an empty line there; lines without a word do not count.
    worded = np.searchsorted(starts, ends) > np.searchsorted(starts, begins)
    begins, ends = begins[worded], ends[worded]
    row = np.searchsorted(offsets, begins, "right") - 1
    hashed = shingles.word_hashes(data, begins, ends, fold_case=False)
    order = np.lexsort((hashed, row))
    again = (row[order][1:] == row[order][:-1]) & (hashed[order][1:] == hashed[order][:-1])
    return np.bincount(row[order][1:][again], minlength=len(offsets) - 1)


def _repeats(row: np.ndarray, hashed: np.ndarray, rows: int, size: int = WINDOW) -> np.ndarray:
    """Per text, the words that lie in a window of ``size`` words found twice or more in it."""
    windows = len(row) - size + 1
    if windows < 2:
        return np.zeros(rows, np.int64)
    folded = np.zeros(windows, np.uint64)
    for k in range(size):
        folded = folded * np.uint64(0xD6E8FEB86659FD93) + hashed[k : k + windows]
    whole = np.flatnonzero(row[:windows] == row[size - 1 :])
    of, key = row[whole], shingles.mix(folded[whole])
    order = np.lexsort((key, of))
    same = (of[order][1:] == of[order][:-1]) & (key[order][1:] == key[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    at = whole[order[twice]]
    edge = np.zeros(len(row) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return np.bincount(row[np.cumsum(edge[:-1]) > 0], minlength=rows)


def judge(docs: DataFrame, reference: dict) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``kept``, ``char_distance`` and ``word_distance``.

    The distances are NULL below the least lengths, and then reject nothing. NULL texts are empty:
    they have no words, so they fail the base rules. Repeated rows are judged alike; other columns are ignored.
    """
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance"]
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, char_distance double, word_distance double"

    def look(batches):
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for first, last, data, offsets in shingles.slices(batch.column(2)):
                rows = last - first
                row, starts, ends = shingles.words(data, offsets)
                n_words = np.bincount(row, minlength=rows)
                at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                word_chars = np.bincount(row, at[ends] - at[starts], minlength=rows).astype(np.int64)
                symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
                repeats = _repeats(row, shingles.word_hashes(data, starts, ends, fold_case=False), rows)
                failed = (n_words < FEWEST_WORDS) | (100 * repeats > 20 * n_words)
                classes = _class_counts(data, offsets)
                folded = shingles.word_hashes(data, starts, ends)
                begin = np.searchsorted(row, np.arange(rows + 1))
                far = np.full((2, rows), np.nan)
                for r in range(rows):
                    known = reference.get(langs[first + r])
                    if known is None:
                        continue
                    if classes[r].sum() >= LEAST_CHARS:
                        far[0, r] = distance(classes[r] / classes[r].sum(), known["classes"])
                    if n_words[r] >= LEAST_WORDS:
                        mine = folded[begin[r] : begin[r + 1]]
                        place = np.searchsorted(known["words"], mine)
                        if len(known["words"]):
                            place = np.where(known["words"][np.minimum(place, len(known["words"]) - 1)] == mine, place, len(known["words"]))
                        far[1, r] = distance(np.bincount(place, minlength=len(known["shares"])) / len(mine), known["shares"])
                with np.errstate(invalid="ignore"):
                    kept = ~failed & ~(far[0] > FARTHEST_CHARS) & ~(far[1] > FARTHEST_WORDS)
                long = [n_words, word_chars, symbols[offsets[1:]] - symbols[offsets[:-1]], _lines(data, offsets, starts), repeats]
                told = [pa.array(f, mask=np.isnan(f)) for f in far]
                yield pa.RecordBatch.from_arrays(
                    [pc.cast(batch.column(0).slice(first, rows), pa.int64()), *[pa.array(c.astype(np.int64)) for c in long], pa.array(failed), pa.array(kept), *told], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text").mapInArrow(look, schema)

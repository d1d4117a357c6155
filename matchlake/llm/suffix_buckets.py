"""Removal of byte passages that occur more than once, by bucket-pointer refinement over the suffixes of all texts.

Every suffix of a text gets a bucket identifier, at first that of the q-gram it is held by, and buckets are refined until
they are ``length`` bytes deep; suffixes that still share a bucket then begin the same passage. Refinement is the doubling
step: a bucket twice as deep is named by a suffix's own identifier and the identifier of the suffix as many bytes later,
and each new identifier serves the next step. Identifiers are 128-bit names that depend on the bytes alone, so tasks agree
on them without numbering, and the shuffle that groups equal names takes the place of the sort. Buckets of one suffix end.

Suffixes are not shuffled one by one. The q-gram of least hash among those inside a suffix's first ``length`` bytes is its
landmark; equal beginnings have it at the same distance. A row is a landmark and the range of distances (cell) of the
suffixes it holds. Of a cell, ``inner`` names the bytes that all its suffixes share, ``outer`` the bytes that they cover
together:

1. the first cell holds all distances; its inner name is the q-gram, so the first buckets are the q-gram buckets;
2. equal outer names: every suffix of the cell is repeated. An inner name on its own: none is;
3. else the cell is cut (into about a seventh each time) and its parts are named from later offsets, till a cell is one
   suffix. Only cells at the edge of a repeated passage come to this, carried with the bytes around their landmark.

A settled cell stays as a witness, one for each outer name, while an open cell shares its bucket. All steps are joins and
aggregations on names with map-side combination; no bucket is collected, and no row is made for a pair.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.shingles import mix, slices
from matchlake.llm.storing import discard, stored

LENGTH = 400
#: Texts are taken in slices of so many bytes, which stay in a processor's cache; a longer text in pieces with the bytes around.
PIECE = 1 << 16
_PLACE_BITS = 24
_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LATER, _STEP, _HALF = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(32)


def gram_size(length: int) -> int:
    """How many bytes a landmark has: a power of two near a sixth of ``length``."""
    return 1 << max(0, (length // 6).bit_length() - 1)


def widths(length: int) -> list[int]:
    """How many distances a cell holds, step by step; each divides the one before, the first holds all."""
    held = length - gram_size(length) + 1
    root = math.ceil(round(held ** (1 / 3), 9))
    return sorted({held, min(held, root * root), min(held, root), 1}, reverse=True)


def _joined(own: np.ndarray, later: np.ndarray, factor: np.uint64) -> np.ndarray:
    """The identifier of two neighbouring strings from those of each."""
    out = own * factor
    out += later * _LATER
    out ^= out >> _HALF
    out *= _STEP
    out ^= out >> _HALF
    return out


def _grams(data: np.ndarray, size: int, factor: np.uint64) -> np.ndarray:
    """The identifier of the ``size`` bytes at each place: bytes side by side up to eight, then doubled."""
    ids, n = data.astype(np.uint64), 1
    while n < min(size, 8):
        ids, n = ids[:-n] | (ids[n:] << np.uint64(8 * n)), 2 * n
    ids = mix(ids ^ factor)
    while n < size:
        ids, n = _joined(ids[:-n], ids[n:], factor), 2 * n
    return ids


def _name(grams: np.ndarray, size: int, at: np.ndarray, long: int, factor: np.uint64) -> np.ndarray:
    """The identifier of the ``long`` bytes at each of the places ``at``, refined from identifiers of grams."""
    if long == size:
        return grams[at]
    half = size << ((long - 1) // size).bit_length() - 1
    own, later = _name(grams, size, at, half, factor), _name(grams, size, at + (long - half), half, factor)
    return _joined(own, later if long == 2 * half else later ^ np.uint64(long), factor)


def _blobs(halves: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """Two halves as 16 bytes each; NULL where not valid."""
    packed = np.ascontiguousarray(halves.T)
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(packed), [None, pa.py_buffer(packed)])
    out = fixed.cast(pa.binary())
    return out if valid is None else pa.compute.if_else(pa.array(valid), out, pa.scalar(None, pa.binary()))


def _least_places(order: np.ndarray, held: int) -> np.ndarray:
    """The least entry of each run of ``held`` entries."""
    n = 1
    while 2 * n <= held:
        order, n = np.minimum(order[:-n], order[n:]), 2 * n
    return np.minimum(order[: len(order) - (held - n)], order[held - n :]) if held > n else order


def _pieces(start: int, end: int, piece: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """First and last suffix (exclusive) of each piece of a text from ``start`` to ``end``, and the bytes it needs."""
    for first in range(start, end - length + 1, piece):
        last = min(first + piece, end - length + 1)
        yield first, last, max(start, first - length), min(end, last + 2 * length)


def landmarks(texts: DataFrame, length: int = LENGTH, piece: int = PIECE) -> DataFrame:
    """Of each ``text`` of ``length`` bytes or more, the landmarks that hold its suffixes.

    ``key`` (16 bytes of the text's SHA-256), ``a`` (place of the landmark), ``lo`` and ``hi`` (least and greatest distance of
    a suffix it holds), ``inner`` (64 bits of its q-gram's name) and ``outer`` (name of all bytes that suffixes at any
    distance cover; NULL where these leave the text). Texts that repeat within a batch are described once.
    """
    size = gram_size(length)
    held = length - size + 1
    low_bits = np.uint64((1 << _PLACE_BITS) - 1)

    def held_by(data, starts, ends, first, last):
        """Landmark, row and least and greatest distance, for suffixes from ``first`` to ``last`` (exclusive) of each row."""
        grams = [_grams(data, size, factor) for factor in (_ONE, _TWO)]
        least = _least_places((grams[0] & ~low_bits) | np.arange(len(grams[0]), dtype=np.uint64), held) & low_bits
        n = last - first
        row = np.repeat(np.arange(len(n)), n)
        suffix = np.arange(len(row)) + np.repeat(first - (np.cumsum(n) - n), n)
        at = least[suffix].astype(np.int64)
        opens = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        closes = np.concatenate([opens[1:], [len(at)]]) - 1
        a, row = at[opens], row[opens]
        inside = (a - (held - 1) >= starts[row]) & (a + length <= ends[row])
        outer = np.zeros((2, len(a)), np.uint64)
        for k, factor in enumerate((_ONE, _TWO)):
            outer[k, inside] = _name(grams[k], size, a[inside] - (held - 1), length + held - 1, factor)
        return a, row, a - suffix[closes], a - suffix[opens], grams[0][a].view(np.int64), outer, inside

    def describe(batches):
        def flush(held_rows):
            keys, a, lo, hi, inner, outer, inside = zip(*held_rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for part in keys for k in part], pa.binary()), *[pa.array(np.concatenate(x).astype(np.int32)) for x in (a, lo, hi)],
                 pa.array(np.concatenate(inner)), _blobs(np.concatenate(outer, axis=1), np.concatenate(inside))],
                ["key", "a", "lo", "hi", "inner", "outer"])

        for batch in batches:
            seen: set[bytes] = set()
            out, many = [], 0
            for _, _, data, offsets in slices(batch.column(0), piece):
                wanted, keys = [], []
                for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    if end - start >= length:
                        key = hashlib.sha256(data[start:end]).digest()[:16]
                        if key not in seen:
                            seen.add(key)
                            keys.append(key)
                            wanted.append((start, end))
                starts, ends = np.array(wanted, np.int64).reshape(-1, 2).T
                if len(wanted) == 1:
                    parts = [(left, right, np.array([first]), np.array([last])) for first, last, left, right in _pieces(*wanted[0], piece, length)]
                else:
                    parts = [(0, len(data), starts, ends - length + 1)] if wanted else []
                for left, right, first, last in parts:
                    a, row, lo, hi, *rest = held_by(data[left:right], starts - left, ends - left, first - left, last - left)
                    out.append(([keys[r] for r in row.tolist()], a + left - starts[row], lo, hi, *rest))
                    many += len(a)
                    if many >= 1 << 15:
                        yield from flush(out)
                        out, many = [], 0
            if out:
                yield from flush(out)

    return texts.select("text").mapInArrow(describe, "key binary, a int, lo int, hi int, inner long, outer binary")


def _surroundings(marked: DataFrame, length: int) -> DataFrame:
    """``marks`` of each ``text``, one row each with the bytes (``around``) that its suffixes can cover, and how many of
    them stand before the landmark (``before``)."""
    reach = length - gram_size(length)

    def cut(batches):
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                data, marks = text.as_buffer().to_pybytes(), batch.column(2)[i].values
                a = marks.field("a").to_numpy()
                begin = np.maximum(0, a - reach)
                for first in range(0, len(a), 4096):
                    some = slice(first, first + 4096)
                    k = len(a[some])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column(0)[i].as_py()] * k, pa.binary()), *[marks.field(c).slice(first, k) for c in ("a", "lo", "hi", "open")],
                         pa.array((a - begin)[some].astype(np.int32)),
                         pa.array([data[b : x + length] for b, x in zip(begin[some].tolist(), a[some].tolist())], pa.binary())],
                        ["key", "a", "lo", "hi", "open", "before", "around"])

    # As bytes: places count bytes, not characters.
    return marked.select("key", F.encode("text", "UTF-8").alias("text"), "marks").mapInArrow(
        cut, "key binary, a int, lo int, hi int, open boolean, before int, around binary")


def _cells(rows: DataFrame, width: int, parent: int, length: int) -> DataFrame:
    """The cells of ``width`` distances inside the parent cell ``cell`` that hold a suffix, with their names.

    Rows keep ``key``, ``a``, ``open``, ``before`` and ``around``; ``lo`` and ``hi`` become those of the cell's suffixes.
    """
    size = gram_size(length)
    held = length - size + 1

    def name(batches):
        for whole in batches:
            offsets, _ = _bytes(whole.column("around"))
            first = 0
            while first < len(whole):
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE, "right")) - 1)
                yield named(whole.slice(first, last - first))
                first = last

    def named(batch):
        lo, hi, cell, before = (batch.column(c).to_numpy().astype(np.int64) for c in ("lo", "hi", "cell", "before"))
        lo, hi = np.maximum(lo, cell), np.minimum(hi, cell + parent - 1)
        n = hi // width - lo // width + 1
        row = np.repeat(np.arange(len(n)), n)
        low = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + (lo // width)[row]) * width
        high = np.minimum(low + width, held) - 1
        ends, data = _bytes(batch.column("around"))
        begins, at, stops = ends[row], ends[row] + before[row], ends[row + 1]
        inner, outer = [np.zeros((2, len(row)), np.uint64) for _ in range(2)]
        covered = (at - high >= begins) & (at + length - low <= stops)
        for k, factor in enumerate((_ONE, _TWO)):
            grams = _grams(np.concatenate([data, np.zeros(size, np.uint8)]), size, factor)
            for span in np.unique(high - low).tolist():
                same = high - low == span
                inner[k, same] = _name(grams, size, at[same] - low[same], length - span, factor)
                fits = same & covered
                outer[k, fits] = _name(grams, size, at[fits] - high[fits], length + span, factor) if span else inner[k, fits]
        keep = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [batch.column("key").take(keep), batch.column("a").take(keep), pa.array(np.maximum(lo[row], low).astype(np.int32)),
             pa.array(np.minimum(hi[row], high).astype(np.int32)), pa.array(low.astype(np.int32)), batch.column("open").take(keep),
             _blobs(inner), _blobs(outer, covered)],
            ["key", "a", "lo", "hi", "cell", "open", "inner", "outer"])

    return rows.select("a", "lo", "hi", "cell", "open", "key", "before", "around").mapInArrow(
        name, "key binary, a int, lo int, hi int, cell int, open boolean, inner binary, outer binary")


def _bytes(blobs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The offsets of a binary column's rows in one run of bytes, and the run."""
    whole = blobs.cast(pa.large_binary())
    ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2], np.uint8) if whole.buffers()[2] is not None else np.zeros(0, np.uint8)
    return ends - ends[0], data[ends[0] : ends[-1]]


def _place() -> Column:
    return F.xxhash64("key", "a")


def _several(rows: DataFrame, name: str, *more: Column) -> DataFrame:
    """The names that stand at two places or more, with the least of them as ``witness``."""
    return rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.min(_place()).alias("witness"), F.max(_place()).alias("other"), *more).where(
        "witness <> other").drop("other")


def _settled(rows: DataFrame, width: int) -> tuple[DataFrame, DataFrame | None]:
    """Suffix ranges (``key``, ``first``, ``last``) of the open cells now known to be repeated, and the cells that go on.

    ``rows`` is a stored table and is deleted.
    """
    shared = stored(_several(rows, "outer"))
    told = stored(rows.join(shared, "outer", "left").drop("outer"))
    discard(rows, shared)
    repeated = stored(told.where("open AND witness IS NOT NULL").select(
        "key", (F.col("a") - F.col("hi")).alias("first"), (F.col("a") - F.col("lo")).alias("last")))
    if width == 1:
        discard(told)
        return repeated, None
    live = told.where((F.col("witness").isNull()) | (F.col("witness") == _place())).withColumn("open", F.col("open") & F.col("witness").isNull())
    buckets = stored(_several(live, "inner", F.max("open").alias("asked")).where("asked").select("inner"))
    going = stored(live.join(buckets, "inner", "left_semi").drop("inner", "witness"))
    discard(told, buckets)
    return repeated, going


def repeated_ranges(docs: DataFrame, settled: DataFrame | None = None, length: int = LENGTH, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """Where the distinct texts of ``docs`` (column ``text``) hold repeated passages, and these texts.

    First ``key``, ``first``, ``last``: ranges of the places (from 0) at which a string of ``length`` bytes begins that also
    begins at another place of a distinct text. Then ``key`` and ``text`` of the texts concerned. A range may come twice.
    Texts whose ``key`` is in ``settled`` are not asked about; they still bear witness for others.
    """
    texts = docs.where(F.octet_length("text") >= length).select("text")
    steps = widths(length)
    marks = stored(landmarks(texts, length, piece))
    # The q-gram buckets. A bucket of one ends here; that is most of them.
    shared = stored(_several(marks, "inner").select("inner"))
    rows = marks.join(shared, "inner", "left_semi")
    if settled is not None:
        rows = rows.join(settled.select("key", F.lit(False).alias("open")), "key", "left")
    rows = stored(rows.withColumn("open", F.coalesce("open", F.lit(True)) if settled is not None else F.lit(True)))
    discard(marks, shared)
    none = rows.limit(0).drop("inner", "outer")
    found, going = _settled(rows, steps[0])
    going = none if going is None else going
    ranges = [found]

    keys = going.select("key").unionByName(found.select("key")).distinct()
    distinct = texts.select(_key().alias("key"), "text").dropDuplicates(["key"])
    concerned = stored(distinct.join(stored(keys), "key", "left_semi"))
    marked = going.groupBy("key").agg(F.collect_list(F.struct("a", "lo", "hi", "open")).alias("marks"))
    around = stored(_surroundings(concerned.join(marked, "key"), length))
    discard(going)
    cells = around.select("key", "a", "lo", "hi", "open", F.lit(0).alias("cell"), "before", "around")
    for parent, width in zip(steps, steps[1:]):
        named = stored(_cells(cells, width, parent, length))
        found, going = _settled(named, width)
        ranges.append(found)
        if going is not None:
            cells = going.join(around.select("key", "a", "before", "around").dropDuplicates(["key", "a"]), ["key", "a"])
    discard(around)
    every = ranges[0]
    for more in ranges[1:]:
        every = every.unionByName(more)
    return every, concerned


def _key() -> Column:
    return F.substring(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), 1, 16)


def _cut_out(held: DataFrame, length: int) -> DataFrame:
    """Of each ``text`` and its ``ranges``: bytes removed, maximal runs of them, and the SHA-256 of the rest."""
    def cut(batches):
        for batch in batches:
            out = []
            for i, text in enumerate(batch.column(1)):
                data, ranges = memoryview(text.as_buffer()), batch.column(2)[i].values
                first, last = (ranges.field(c).to_numpy().astype(np.int64) for c in ("first", "last"))
                order = np.argsort(first, kind="stable")
                first, last = first[order], np.maximum.accumulate(last[order] + length)
                opens = np.flatnonzero(np.concatenate([[True], first[1:] > last[:-1]]))
                starts, ends = first[opens], last[np.concatenate([opens[1:], [len(first)]]) - 1]
                rest, done = hashlib.sha256(), 0
                for start, end in zip(starts.tolist(), ends.tolist()):
                    rest.update(data[done:start])
                    done = end
                rest.update(data[done:])
                out.append((int((ends - starts).sum()), len(starts), rest.hexdigest()))
            removed, spans, rest = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(rest, pa.string())],
                ["key", "n_removed", "n_spans", "kept_sha256"])

    return held.select("key", F.encode("text", "UTF-8").alias("text"), "ranges").mapInArrow(
        cut, "key binary, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = LENGTH, piece: int = PIECE) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``.

    A byte of a text is removed when a string of ``length`` bytes covers it that begins at another place too, of the same text
    or of another row's. Matches do not cross texts and are judged on the texts as given. NULL counts as an empty text; texts
    shorter than ``length``, empty ones among them, keep all bytes. Rows that repeat a text, with the same doc_id or without
    one, are repeated passages of each other. Long texts are worked through in pieces. Other columns are ignored; no rows
    give no rows. A task holds the texts of a batch and the ranges of one text, never a bucket.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    narrow = stored(texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")))
    key = F.substring(F.unhex("sha"), 1, 16)
    long = narrow.where(F.col("n_bytes") >= length)
    copied = long.groupBy(key.alias("key")).agg(F.count("*").alias("n")).where("n > 1").select("key")
    copies = stored(copied)
    ranges, concerned = repeated_ranges(texts, copies, length, piece)
    held = ranges.join(copies, "key", "left_anti").groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    cut = _cut_out(concerned.join(held, "key"), length)
    # A text that stands in several rows is repeated as a whole.
    nothing = copies.select("key", F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.sha2(F.lit(b""), 256).alias("kept_sha256"))
    verdict = stored(cut.unionByName(nothing))
    discard(concerned, copies)
    told = narrow.withColumn("key", key).join(verdict, "key", "left")
    touched = F.col("n_spans").isNotNull()
    return told.select(
        "doc_id", "n_bytes",
        F.when(touched, F.coalesce("n_removed", "n_bytes")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )

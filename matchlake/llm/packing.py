"""Best-fit packing of documents into bins under conflicts.

A bin holds so many code points. It never holds two pieces of one duplicate cluster, and at most ``PER_SOURCE`` pieces
of one source. Every bin carries a bitmap of its clusters and ``PER_SOURCE`` bitmaps of its sources (bit s of the k-th is
set when the bin has k pieces of source s), so compatibility is two bit tests. Bins are ordered by what is left in them; a
piece, longest first, starts at the smallest residual that holds it and goes on to the next larger one until a bin is
compatible; if none is, it opens a new bin. That bin is the tightest compatible one. Bins stand in blocks that know what all
of their bins refuse, so a search passes over the bins that are closed to a hot source block by block.

Rows are dealt by hash into shards of about ``SHARD_CHARS`` code points, each packed by itself: the number of shards
follows the input, and a shard is bounded, whatever source or cluster is hot. Texts are not moved, only their lengths.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITY = 16384
PER_SOURCE = 4
SHARD_CHARS = 1 << 25
SCHEMA = "bin_id string, doc_id long, copy int, source string, start long, end long, place int, bin_used long"


def text_cluster(text: Column) -> Column:
    """A key that texts of the same words share: case and white space do not matter."""
    return F.md5(F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " ")).cast("binary"))


class _Residuals:
    """Bins ordered by what is left in them, in blocks. ``refused`` holds per block the bits that all of its bins have in ``marks``,
    so that the search passes over a block that refuses a source or cluster without looking at its bins."""

    BLOCK = 256

    def __init__(self, marks: list[int]):
        self.marks, self.blocks, self.highest, self.refused = marks, [], [], []

    def take(self, least: tuple[int, int], mask: int) -> tuple[int, int] | None:
        """Remove and return the first (residual, bin) from ``least`` on whose marks have no bit of ``mask``."""
        for k in range(bisect_left(self.highest, least), len(self.blocks)):
            if self.refused[k] & mask:
                continue
            block = self.blocks[k]
            for at in range(bisect_left(block, least), len(block)):
                if not self.marks[block[at][1]] & mask:
                    found = block.pop(at)
                    self._replace(k, [block] if block else [])
                    return found
        return None

    def add(self, entry: tuple[int, int]) -> None:
        if not self.blocks:
            self._replace(0, [[entry]])
            return
        k = min(bisect_left(self.highest, entry), len(self.blocks) - 1)
        block = self.blocks[k]
        insort(block, entry)
        if len(block) > 2 * self.BLOCK:
            self._replace(k, [block[: self.BLOCK], block[self.BLOCK :]])
        else:
            self.highest[k] = block[-1]
            self.refused[k] &= self.marks[entry[1]]

    def _replace(self, k: int, blocks: list) -> None:
        """Put ``blocks`` in the place of block ``k``."""
        common = []
        for block in blocks:
            bits = -1
            for _, b in block:
                bits &= self.marks[b]
                if not bits:
                    break
            common.append(bits)
        self.blocks[k : k + 1], self.highest[k : k + 1], self.refused[k : k + 1] = blocks, [block[-1] for block in blocks], common


def pack_items(items: list[tuple], capacity: int, per_source: int) -> list[list[int]]:
    """Bins of item numbers, best fit by falling size. An item is (size, cluster, source, ...), no longer than a bin.

    An item without cluster (None) is like no other.
    """
    # Frequent sources and clusters have the lowest bits, so that bitmaps that blocks have in common stay short.
    source_bit = {s: 1 << k for k, (s, _) in enumerate(Counter(i[2] for i in items).most_common())}
    often = Counter(i[1] for i in items if i[1] is not None).most_common()
    cluster_bit = {c: 1 << k for k, c in enumerate((c for c, n in often if n > 1), len(source_bit))}
    order = sorted(range(len(items)), key=lambda k: (-items[k][0], items[k][1] or "", items[k][2:]))
    #: Per bin: its clusters and the sources it has ``per_source`` pieces of, and the bitmaps of fewer pieces.
    marks: list[int] = []
    fewer, held = [], []
    left = _Residuals(marks)
    last, resume = None, (0, -1)
    for k in order:
        size, cluster, source = items[k][:3]
        bit_c, bit_s = cluster_bit.get(cluster, 0), source_bit[source]
        # Bins that refused an equal item before refuse this one too.
        least = max((size, -1), resume) if last == (size, cluster, source) and bit_c else (size, -1)
        found = left.take(least, bit_c | bit_s)
        if found is None:
            residual, b = capacity, len(held)
            marks.append(0)
            fewer.append([0] * (per_source - 1))
            held.append([])
            resume = (capacity + 1, -1)
        else:
            residual, b = found
            resume = found
        marks[b] |= bit_c
        for plane in range(per_source - 1):
            if not fewer[b][plane] & bit_s:
                fewer[b][plane] |= bit_s
                break
        else:
            marks[b] |= bit_s
        held[b].append(k)
        left.add((residual - size, b))
        last = (size, cluster, source)
    return held


def pack(docs: DataFrame, cluster: Column | None = None, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """The packing, one row per piece: ``bin_id``, ``doc_id``, ``copy``, ``source``, ``start``, ``end``, ``place``, ``bin_used``.

    ``start`` and ``end`` are code points of the document's text, ``place`` is the piece's order in its bin, ``bin_used``
    the code points in the bin. ``cluster`` names a row's duplicate cluster (by default, texts of the same words). A text longer
    than a bin is cut into full bins, which nothing else fits into, and a rest that is packed like any piece; NULL and empty
    texts are pieces without characters and without cluster. Rows that repeat a document (same id, source and text) are numbered by ``copy`` from 1;
    NULL ids and sources are kept, a NULL source is a source. Other columns are ignored. No rows give no rows.
    """
    key = text_cluster(F.coalesce("text", F.lit(""))) if cluster is None else cluster.cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.when(F.length("text") > 0, key).alias("cluster"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"),
    ).groupBy("doc_id", "source", "cluster", "n").agg(F.count("*").alias("copies"))
    total = docs.agg(F.sum(F.length("text")).alias("chars"), F.count("*").alias("rows")).first()
    # A row without characters still takes room in the task.
    shards = 1 + ((total["chars"] or 0) + 64 * total["rows"]) // shard_chars
    copies = rows.select("doc_id", "source", "cluster", "n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    full = F.floor(F.col("n") / capacity).cast("long")
    dealt = copies.withColumn("shard", F.pmod(F.xxhash64("doc_id", "source", "cluster", "copy"), F.lit(shards))).withColumn("full", full)

    whole = dealt.where("full > 0").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1))).select(
        F.concat_ws("-", F.lit("whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")),
                    F.substring(F.md5(F.concat_ws(":", F.coalesce("source", F.lit("")), F.col("source").isNull().cast("string"), "cluster", F.col("n").cast("string")).cast("binary")), 1, 16), "copy", "piece").alias("bin_id"),
        "doc_id", "copy", "source", (F.col("piece") * capacity).alias("start"), ((F.col("piece") + 1) * capacity).alias("end"),
        F.lit(0).alias("place"), F.lit(capacity).cast("long").alias("bin_used"),
    )
    rest = dealt.where(f"full = 0 OR n > full * {capacity}").select("shard", "doc_id", "copy", "source", "cluster", (F.col("full") * capacity).alias("start"), F.col("n").alias("end"))

    def pack_shard(batches):
        """Shards arrive sorted, one after the other."""
        def packed(shard, items):
            bins = pack_items(items, capacity, per_source)
            out = []
            for b, held in enumerate(bins):
                used = sum(items[k][0] for k in held)
                for place, k in enumerate(held):
                    _, _, source, doc_id, copy, start, end = items[k]
                    # An item's id and source are kept with a mark for NULL, so that items can be ordered.
                    out.append((f"{shard}-{b}", doc_id[1] if doc_id[0] else None, copy, source[1] if source[0] else None, start, end, place, used))
            arrays = [pa.array(list(c), t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))]
            return pa.RecordBatch.from_arrays(arrays, ["bin_id", "doc_id", "copy", "source", "start", "end", "place", "bin_used"])

        now, items = None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for shard, doc_id, copy, source, cluster, start, end in zip(*columns):
                if shard != now and items:
                    yield packed(now, items)
                    items = []
                now = shard
                items.append((end - start, cluster, (source is not None, source or ""), (doc_id is not None, doc_id or 0), copy, start, end))
        if items:
            yield packed(now, items)

    return whole.unionByName(rest.repartition("shard").sortWithinPartitions("shard").mapInArrow(pack_shard, SCHEMA))

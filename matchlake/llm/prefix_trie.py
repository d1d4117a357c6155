"""The trie of conversation prefixes: what conversations share, found without shuffling what they do not share.

A node is a distinct sequence of first turns, named by a digest chained over its turns. A count-min sketch counts the
conversations through each digest; it never counts too few, so an estimate of one proves that the node, and with it every
node below, belongs to one conversation. Such tails are complete where they stand and are emitted by the task that reads
the conversation. Only prefixes that may be shared are shuffled, to be grouped exactly; a false alarm of the sketch costs
a row and nothing else. The sketch has ``SKETCH_ROWS`` times ``WIDEST`` bytes at most, which is all that is ever broadcast.

Sums over subtrees double their reach: after step k a node's sum covers the nodes less than 2^(k+1) levels below, by adding
the sums of the nodes 2^k levels below. Each node carries the digests of its ancestors at those distances.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.storing import stored

SKETCH_ROWS = 4
#: Counters of a sketch row, at least and at most; in between four for each turn.
NARROWEST, WIDEST = 1 << 10, 1 << 22
BLOCK = 1 << 16
CHUNK = 1 << 18
_DIGEST = 16
_ROOT = bytes(_DIGEST)
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def paths(turns: DataFrame) -> DataFrame:
    """``conv_id`` and its ``turns`` in order, each as ``digest`` (16 bytes of role and text) and ``chars`` (code points).

    In order of ``turn``, NULL first; ties by role and text. NULL roles and texts count as empty; rows without conv_id belong
    to no conversation. Texts stay behind: a conversation is gathered as 24 bytes a turn.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    placed = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)), 1, _DIGEST)
    told = placed.withColumn("place", F.row_number().over(order)).select(
        "conv_id", F.struct("place", digest.alias("digest"), F.length("text").cast("long").alias("chars")).alias("t"))
    return told.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def spliced(own: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Conversations rebuilt from ``paths``: the first h turns of conversation c - c % ``every``, then c's own after its first h.

    h is the unsigned crc32 of decimal c, modulo ``most``. A conversation that is not there lends no turns.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = own.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    none = F.expr("array()").cast(own.schema["turns"].dataType)
    joined = own.withColumn("base", base).withColumn("h", h).join(heads, "base", "left")
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns") + 1)).alias("turns"))


def _chained(conversations: DataFrame) -> DataFrame:
    """``conv_id``, the digests of all prefixes from the root on (``prefixes``, 16 bytes each) and ``chars`` of each turn."""
    def chain(batches):
        for batch in batches:
            out = []
            for turns in batch.column(1).to_pylist():
                now, every = _ROOT, [_ROOT]
                for turn in turns:
                    now = hashlib.blake2b(now + turn["digest"], digest_size=_DIGEST).digest()
                    every.append(now)
                out.append((b"".join(every), [turn["chars"] for turn in turns]))
            prefixes, chars = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prefixes, pa.binary()), pa.array(chars, pa.list_(pa.int64()))], ["conv_id", "prefixes", "chars"])

    return conversations.select("conv_id", "turns").mapInArrow(chain, "conv_id long, prefixes binary, chars array<long>")


def _digests(blobs: pa.Array) -> np.ndarray:
    """All digests of a column of prefixes, two numbers each."""
    return np.frombuffer(b"".join(blobs.to_pylist()), np.uint64).reshape(-1, 2)


def _counters(digests: np.ndarray, width: int) -> np.ndarray:
    """The counter of each digest in each row of the sketch."""
    row = np.arange(SKETCH_ROWS, dtype=np.uint64)[:, None]
    return ((digests[:, 0] + row * (digests[:, 1] | np.uint64(1))) >> np.uint64(16)) % np.uint64(width)


def sketch(chained: DataFrame, width: int) -> np.ndarray:
    """How many conversations go through each counter, two standing for more: ``SKETCH_ROWS`` by ``width`` bytes."""
    def count(batches):
        cells = np.zeros((SKETCH_ROWS, width), np.uint8)
        for batch in batches:
            at = _counters(_digests(batch.column(0)), width)
            for k in range(SKETCH_ROWS):
                cells[k] = np.minimum(2, cells[k] + np.minimum(2, np.bincount(at[k].astype(np.int64), minlength=width)))
        flat = cells.ravel()
        for block in range(0, len(flat), BLOCK):
            part = flat[block : block + BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([block // BLOCK], pa.int32()), pa.array([part.tobytes()])], ["block", "cells"])

    def merge(batches):
        now, held = None, None
        for batch in batches:
            for block, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(cells.as_buffer(), np.uint8)
                if block != now:
                    if held is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([held.tobytes()])], ["block", "cells"])
                    now, held = block, part.copy()
                else:
                    held = np.minimum(2, held + part)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([held.tobytes()])], ["block", "cells"])

    schema = "block int, cells binary"
    partial = chained.select("prefixes").mapInArrow(count, schema)
    merged = partial.repartition("block").sortWithinPartitions("block").mapInArrow(merge, schema)
    flat = np.zeros(SKETCH_ROWS * width, np.uint8)
    for row in merged.toLocalIterator():
        flat[row["block"] * BLOCK : row["block"] * BLOCK + len(row["cells"])] = np.frombuffer(row["cells"], np.uint8)
    return flat.reshape(SKETCH_ROWS, width)


def _screened(chained: DataFrame, width: int) -> DataFrame:
    """One row per prefix. A tail's rows have no ``digest``, and ``up`` only where its parent may be shared.

    ``up`` holds the digests 1, 2, 4, ... levels above, 16 bytes each, ``last`` tells whether the conversation ends here.
    """
    known = chained.sparkSession.sparkContext.broadcast(sketch(chained, width))

    def screen(batches):
        cells = known.value
        for batch in batches:
            digests = _digests(batch.column(1))
            single = np.min(np.stack([cells[k][at.astype(np.int64)] for k, at in enumerate(_counters(digests, width))]), axis=0) == 1
            digest, up, depth, conv, chars, last, begin = [], [], [], [], [], [], 0
            for conv_id, blob, of_turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                n = len(of_turns)
                alone = np.flatnonzero(single[begin : begin + n + 1])
                tail = int(alone[0]) if len(alone) else n + 1
                begin += n + 1
                for d in range(n + 1):
                    above = [blob[_DIGEST * (d - (1 << k)) :][:_DIGEST] for k in range(d.bit_length())] if d < tail else [blob[_DIGEST * (d - 1) :][:_DIGEST]] if d == tail and d else None
                    digest.append(blob[_DIGEST * d :][:_DIGEST] if d < tail else None)
                    up.append(None if above is None else b"".join(above))
                depth.append(np.arange(n + 1))
                conv.append(np.full(n + 1, conv_id))
                chars.append(np.array([0, *of_turns], np.int64))
                last.append(np.arange(n + 1) == n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest, pa.binary()), pa.array(up, pa.binary()), *[pa.array(np.concatenate(x) if x else [], t) for x, t in (
                    (depth, pa.int64()), (conv, pa.int64()), (chars, pa.int64()), (last, pa.bool_()))]],
                ["digest", "up", "depth", "conv_id", "chars", "last"])

    return chained.mapInArrow(screen, "digest binary, up binary, depth long, conv_id long, chars long, last boolean")


def _ends(shared: DataFrame) -> DataFrame:
    """``digest`` and the SHA-256 of the conversations that end there, ascending and comma-joined.

    They are sorted by range, so one node's may lie in many tasks; each joins its own into chunks, which are then hashed in order.
    """
    def join(batches):
        now, held, long = None, [], 0

        def chunk():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([held[0]], pa.int64()), pa.array([",".join(map(str, held))])], ["digest", "first", "ids"])

        for batch in batches:
            for digest, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (digest != now or len(held) >= CHUNK):
                    yield chunk()
                    held = []
                now = digest
                held.append(conv_id)
        if held:
            yield chunk()

    def hashed(batches):
        now, state = None, None
        for batch in batches:
            done = []
            for digest, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if digest != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = digest, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done])], ["digest", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], ["digest", "ends_sha256"])

    ordered = shared.where("last").select("digest", "conv_id").repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    chunks = ordered.mapInArrow(join, "digest binary, first long, ids string")
    return chunks.repartition("digest").sortWithinPartitions("digest", "first").mapInArrow(hashed, "digest binary, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of ``conversations`` (``conv_id`` and ``turns`` as of ``paths``, one row each).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (that of the prefix one turn shorter; NULL for the root),
    ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless nodes of the subtree, itself included), ``saved_tokens``
    (over the subtree, the last turn's code points times members less one) and ``ends_sha256`` (of the decimal ids of members
    that end here, ascending and comma-joined; of nothing if none do). Conversations without turns are members of the root;
    no conversations give no rows. A task holds a batch of conversations at 24 bytes a turn, whatever shares a node with them.
    """
    chained = stored(_chained(conversations))
    turns = chained.agg(F.coalesce(F.sum(F.size("chars") + 1), F.lit(0))).first()[0]
    width = min(WIDEST, max(NARROWEST, 1 << (4 * turns).bit_length()))
    screened = stored(_screened(chained, width))
    shared, tails = screened.where("digest IS NOT NULL"), screened.where("digest IS NULL")
    nodes = stored(
        shared.groupBy("digest", "up", "depth", "chars").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    )
    heads = tails.where("up IS NOT NULL")
    parent = F.substring("up", 1, _DIGEST)
    families = (
        nodes.where("depth > 0").select(parent.alias("digest"), F.lit(0).cast("long").alias("tail"))
        .unionByName(heads.select(parent.alias("digest"), F.lit(1).cast("long").alias("tail")))
        .groupBy("digest").agg(F.count("*").alias("n_children"), F.sum("tail").alias("tails"))
    )
    ends = _ends(shared)
    known = nodes.join(families, "digest", "left").join(ends, "digest", "left").select(
        *nodes.columns, F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
        # A tail is one leaf; a shared node without children is one itself.
        F.when(F.col("n_children").isNull(), 1).otherwise(F.col("tails")).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    known = stored(known)
    deepest = known.agg(F.max("depth")).first()[0] or 0
    sums = known.select("digest", "up", "n_leaves", "saved_tokens")
    for k in range(deepest.bit_length()):
        above = F.substring("up", _DIGEST * k + 1, _DIGEST)
        lent = sums.where(F.length("up") > _DIGEST * k).groupBy(above.alias("digest")).agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        sums = stored(sums.join(lent, "digest", "left").select(
            "digest", "up", *[(F.col(own) + F.coalesce(F.col(more), F.lit(0))).alias(own) for own, more in (("n_leaves", "leaves"), ("saved_tokens", "saved"))]))
    whole = known.drop("n_leaves", "saved_tokens").join(sums.drop("up"), "digest").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, parent).alias("parent"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

    def lone(rows: DataFrame) -> DataFrame:
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
        return rows.select(
            "conv_id", "depth", F.when(F.col("up").isNotNull(), parent).alias("parent"), one.alias("n_convs"), F.when(F.col("last"), none).otherwise(one).alias("n_children"),
            one.alias("n_leaves"), none.alias("saved_tokens"),
            F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(_NO_ENDS)).alias("ends_sha256"))

    parents = nodes.select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    joined = whole.unionByName(lone(heads)).join(parents, "parent", "left").drop("parent")
    below = lone(tails.where("up IS NULL")).drop("parent").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    return joined.unionByName(below).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

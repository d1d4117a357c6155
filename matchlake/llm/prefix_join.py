"""Near-duplicate documents by a grouped prefix join over word shingles, exact for any Jaccard threshold.

Two sets can only reach the threshold if they share one of the first few shingles of each (the prefix) under any order
common to all; the order here puts shingles that many documents share last. The steps:

1. count shingles (packed by hash range, so that Spark moves arrays, not rows) and list the most common ones, at most
   ``COMMON`` of them. The list only sets the order: every order gives the same links;
2. give each document its set's size, signature and prefix; equal sets are one class, classes with equal prefix and size
   one group, of which only the leader goes on;
3. find the prefix shingles that several groups share. Common shingles are known and go straight on, the rest is packed by
   hash range and reduced there, so shingles of one document cost a few bytes and no row;
4. star round: of the groups in which a shared shingle stands earliest, the least changed ones of a family of copies, each
   group is verified against the one that most of its shingles name; linked classes become components;
5. full round: all group pairs with a shared shingle, whose size and shingle positions still allow the threshold and which
   are not yet in one component, are expanded to their members and verified. Only components are asked for, so a pair
   inside one component need not be looked at again: a family of copies costs links, not pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm import shingles
from matchlake.llm.components import star_links
from matchlake.llm.storing import discard, stored

THRESHOLD = 75
SHINGLE = 5
COMMON = 1 << 18
SEEN_OFTEN = 8
RANGE_BITS = 12
PACKED_TOKENS = 1 << 21
_LOW_BITS = 28
#: Places of the bitmap of asked documents: 4 MB at most, whatever the corpus.
ASKED_BITS = 1 << 25


def _ranges(sorted_tokens: np.ndarray) -> np.ndarray:
    """Where each hash range begins in sorted tokens, and the end."""
    edges = np.arange(1, 1 << RANGE_BITS, dtype=np.uint64) << np.uint64(64 - RANGE_BITS)
    return np.concatenate([[0], np.searchsorted(sorted_tokens, edges), [len(sorted_tokens)]])


def _planes(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bytes of each number, most significant first, one row per byte."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :].T


def _numbers(planes: np.ndarray) -> np.ndarray:
    """Undo ``_planes``."""
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, 8 - planes.shape[0] :] = planes.T
    return wide.view(">u8").ravel().astype(np.uint64)


def common_shingles(docs: DataFrame, size: int = SHINGLE, most: int = COMMON) -> np.ndarray:
    """At most ``most`` hashes (their upper 40 bits) of shingles that many runs of documents hold, with a class each.

    Returns them as a sorted array of pairs. All documents are counted; a shingle counts once per run of rows.
    """
    schema = "part int, tokens binary"

    def pack(batches):
        held: list[np.ndarray] = []

        def flush():
            tokens = np.sort(np.concatenate(held)) >> np.uint64(64 - RANGE_BITS - _LOW_BITS)
            cuts = _ranges(tokens << np.uint64(64 - RANGE_BITS - _LOW_BITS))
            held.clear()
            parts = np.flatnonzero(np.diff(cuts))
            low = tokens & np.uint64((1 << _LOW_BITS) - 1)
            blobs = [_planes(low[cuts[p] : cuts[p + 1]], 4).tobytes() for p in parts]
            return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], ["part", "tokens"])

        for batch in batches:
            for _, _, data, offsets in shingles.slices(batch.column(0)):
                held.append(np.unique(shingles.shingle_sets(data, offsets, size)[1]))
                if sum(map(len, held)) >= PACKED_TOKENS:
                    yield flush()
        if held:
            yield flush()

    def count(batches):
        tokens, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []

        def merge():
            nonlocal tokens, times
            new, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            every, back = np.unique(np.concatenate([tokens, new]), return_inverse=True)
            times, tokens = np.bincount(back, np.concatenate([times, n])).astype(np.int64), every

        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                planes = np.frombuffer(blob.as_buffer(), np.uint8).reshape(4, -1)
                held.append(_numbers(planes) | np.uint64(part << _LOW_BITS))
            if sum(map(len, held)) >= PACKED_TOKENS:
                merge()
        if held:
            merge()
        often = times >= SEEN_OFTEN
        yield pa.RecordBatch.from_arrays([pa.array(tokens[often].astype(np.int64)), pa.array(times[often])], ["token", "n"])

    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.select("text").mapInArrow(pack, schema).repartition(partitions, "part")
    counted = stored(packed.mapInArrow(count, "token long, n long").withColumn("size_class", F.floor(F.log2("n")).cast("int")))
    room, least = most, 99
    for size_class, n in sorted(((r[0], r[1]) for r in counted.groupBy("size_class").count().collect()), reverse=True):
        if n > room:
            break
        room, least = room - n, size_class
    listed = counted.where(F.col("size_class") >= least).select("token", "size_class").toArrow()
    token, size_class = listed.column(0).to_numpy().astype(np.uint64), listed.column(1).to_numpy()
    order = np.argsort(token)
    return np.stack([token[order], size_class[order].astype(np.uint64)])


def _class_of(tokens: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The class of each token in the list of common ones; 0 for all others."""
    if not common.shape[1]:
        return np.zeros(len(tokens), np.uint64)
    short = tokens >> np.uint64(64 - RANGE_BITS - _LOW_BITS)
    at = np.minimum(np.searchsorted(common[0], short), common.shape[1] - 1)
    return np.where(common[0][at] == short, common[1][at], np.uint64(0))


def prefixes(docs: DataFrame, common: np.ndarray, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles``, two halves of its set's signature, and its ``prefix``, rarest first."""
    schema = "doc_id long, n_shingles long, sig_a long, sig_b long, prefix binary"

    def describe(batches):
        for batch in batches:
            ids = batch.column(0)
            for first, last, data, offsets in shingles.slices(batch.column(1)):
                row, token = shingles.shingle_sets(data, offsets, size)
                n = np.bincount(row, minlength=last - first)
                size_class = _class_of(token, common)
                if size_class.any():
                    order = np.argsort((row.astype(np.uint64) << np.uint64(8)) | size_class, kind="stable")
                    ordered = token[order]
                else:
                    ordered = token
                begin = np.concatenate([[0], np.cumsum(n)])
                # The signature is a sum, so it does not depend on the order.
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(shingles.mix(token ^ np.uint64(k)), dtype=np.uint64)]) for k in (0x5851, 0xF42D4C95)]
                sig = [(s[begin[1:]] - s[begin[:-1]]).astype(np.int64) for s in sums]
                take = np.where(n > 0, n - (threshold * n + 99) // 100 + 1, 0)
                blobs = [ordered[b : b + k].tobytes() for b, k in zip(begin[:-1], take)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, last - first).cast(pa.int64()), pa.array(n), pa.array(sig[0]), pa.array(sig[1]), pa.array(blobs, pa.binary())],
                    ["doc_id", "n_shingles", "sig_a", "sig_b", "prefix"],
                )

    return docs.select("doc_id", "text").mapInArrow(describe, schema)


def _shared_tokens(leaders: DataFrame, common: np.ndarray) -> DataFrame:
    """``token``, ``gid``, ``n``, ``pos`` for the prefix shingles that several groups share (and all common ones).

    ``leaders`` has ``gid``, ``n`` and ``prefix``. Packed rows carry tokens of one hash range; common tokens pass through.
    """
    schema = "part int, packed binary, token long, gid long, n int, pos int"
    names = ["part", "packed", "token", "gid", "n", "pos"]

    def pack(batches):
        def flush(held):
            token, gid, n, pos = (np.concatenate(x) for x in zip(*held))
            usual = _class_of(token, common) == 0
            order = np.argsort(token[usual], kind="stable")
            columns = [c[usual][order] for c in (token, gid, n, pos)]
            cuts = _ranges(columns[0])
            parts = np.flatnonzero(np.diff(cuts))
            blobs = []
            for p in parts:
                one = [c[cuts[p] : cuts[p + 1]] for c in columns]
                blobs.append(np.concatenate([_planes(one[0], 8), _planes(one[1].view(np.uint64), 8), _planes(one[2], 4), _planes(one[3], 4)]).tobytes())
            k = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), pa.array(blobs, pa.binary()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32())], names)
            often = ~usual
            if often.any():
                k = int(often.sum())
                salt = (shingles.mix(gid[often].view(np.uint64) ^ token[often]) >> np.uint64(64 - RANGE_BITS)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(salt), pa.nulls(k, pa.binary()), pa.array(token[often].view(np.int64)), pa.array(gid[often]),
                     pa.array(n[often].astype(np.int32)), pa.array(pos[often].astype(np.int32))], names)

        held, many = [], 0
        for batch in batches:
            for gid, n, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                token = np.frombuffer(blob.as_buffer(), np.uint64)
                k = len(token)
                held.append((token, np.full(k, gid, np.int64), np.full(k, n, np.uint64), np.arange(k, dtype=np.uint64)))
                many += k
                if many >= PACKED_TOKENS // 2:
                    yield from flush(held)
                    held, many = [], 0
        if held:
            yield from flush(held)

    def reduce(batches):
        """Of each hash range, the rows whose token occurs twice or more; ranges arrive one after the other."""
        def repeated(blobs):
            planes = np.concatenate([np.frombuffer(b, np.uint8).reshape(24, -1) for b in blobs], axis=1)
            token = _numbers(planes[:8])
            order = np.argsort(token, kind="stable")
            token = token[order]
            same = token[1:] == token[:-1]
            twice = np.zeros(len(token), bool)
            twice[1:] |= same
            twice[:-1] |= same
            keep = order[twice]
            return pa.RecordBatch.from_arrays(
                [pa.array(token[twice].view(np.int64)), pa.array(_numbers(planes[8:16, keep]).view(np.int64)),
                 pa.array(_numbers(planes[16:20, keep]).astype(np.int32)), pa.array(_numbers(planes[20:, keep]).astype(np.int32))], names[2:])

        now, blobs = None, []
        for batch in batches:
            plain = batch.filter(pc.is_null(batch.column(1)))
            if len(plain):
                yield plain.select(names[2:])
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if blob is None:
                    continue
                if part != now and blobs:
                    yield repeated(blobs)
                    blobs = []
                now = part
                blobs.append(blob)
        if blobs:
            yield repeated(blobs)

    partitions = int(leaders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = leaders.select("gid", F.col("n").cast("int"), "prefix").mapInArrow(pack, schema)
    dealt = packed.repartition(partitions, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(reduce, "token long, gid long, n int, pos int")


def _allowed(threshold: int) -> Column:
    """Whether sizes ``n``/``other_n`` and places ``pos``/``other_pos`` of the first shared shingle allow the threshold."""
    within = (F.least("n", "other_n") * 100) >= (F.greatest("n", "other_n") * threshold)
    most = 1 + F.least(F.col("n") - F.col("pos") - 1, F.col("other_n") - F.col("other_pos") - 1)
    return within & (most * (100 + threshold) >= (F.col("n") + F.col("other_n")).cast("long") * threshold)


def verified(docs: DataFrame, pairs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs (``a``, ``b``) of doc ids whose shingle sets reach the threshold, counted exactly.

    Texts are moved, not their sets, which are larger, and hardly any but those of documents asked for. ``b`` should be the
    end that many pairs share: its pairs stand together then, and its set is made once for a run of them.
    """
    def place(of: str) -> Column:
        return F.pmod(F.xxhash64(of), F.lit(ASKED_BITS)) + 1

    # A bitmap of the asked documents keeps nearly all other texts out of the joins; some pass it and find no pair.
    asked = pairs.select(F.explode(F.array("a", "b")).alias("id")).select(place("id").alias("place"))
    bitmap = asked.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    is_asked = F.expr("shiftright(cast(conv(hex(substring(bits, cast(at div 8 AS int) + 1, 1)), 16, 10) AS int), cast(at % 8 AS int)) & 1 = 1")

    def sets(texts):
        for _, last, data, offsets in shingles.slices(texts):
            row, token = shingles.shingle_sets(data, offsets, size)
            begin = np.searchsorted(row, np.arange(len(offsets)))
            yield from (token[b:e] for b, e in zip(begin[:-1], begin[1:]))

    def compare(batches):
        for batch in batches:
            # Places where another text begins; a run of equal ones is shingled once.
            b, y = batch.column(1).to_numpy(), batch.column(3)
            head = np.ones(len(batch), bool)
            head[1:] = (b[1:] != b[:-1]) | ~pc.equal(y[1:], y[:-1]).to_numpy(zero_copy_only=False)
            centres, centre = sets(y.filter(pa.array(head))), None
            good = np.zeros(len(batch), bool)
            for i, own in enumerate(sets(batch.column(2))):
                if head[i]:
                    centre = next(centres)
                both = np.intersect1d(own, centre, assume_unique=True).size
                good[i] = both > 0 and 100 * both >= threshold * (len(own) + len(centre) - both)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    texts = docs.where("text IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.withColumns({"bucket": F.bitmap_bucket_number(place("doc_id")), "at": F.bitmap_bit_position(place("doc_id"))})
    texts = texts.join(F.broadcast(bitmap), "bucket").where(is_asked).select("doc_id", "text")
    both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x")), "a")
    both = both.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest doc_id reachable by links.

    Two documents are linked when the Jaccard similarity of their shingle sets is ``threshold`` per cent or more. NULL,
    empty and wordless texts have no shingles and are linked with nothing. Rows that share a doc_id are one document with
    the links of all of them. Rows without doc_id keep their size and have no component. Other columns are ignored; no
    rows give no rows.
    """
    common = common_shingles(docs, size)
    described = stored(prefixes(docs, common, size, threshold))
    narrow = described.select("doc_id", "n_shingles", "sig_a", "sig_b", F.md5("prefix").alias("prefix_sig"))
    signature = ["n_shingles", "sig_a", "sig_b"]
    classes = stored(
        narrow.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*signature).agg(
            F.min("doc_id").alias("rep"), F.first("prefix_sig").alias("prefix_sig"))
    )
    # A group: classes with the same size and prefix. Its leader stands for it until pairs are expanded.
    leader = classes.groupBy("n_shingles", "prefix_sig").agg(F.min("rep").alias("gid"))
    members = stored(classes.join(leader, ["n_shingles", "prefix_sig"]).select("gid", "rep", "n_shingles", "prefix_sig"))
    group = ["gid", "n_shingles", "prefix_sig"]
    leaders = (
        described.where("n_shingles > 0").select(F.col("doc_id").alias("gid"), "n_shingles", F.md5("prefix").alias("prefix_sig"), "prefix")
        .join(members.where("gid = rep").select(*group), group, "left_semi")
        .select("gid", F.col("n_shingles").alias("n"), "prefix")
    )
    # A document in several equal rows names its shingles several times, which makes no link.
    tokens = stored(_shared_tokens(leaders, common))
    narrow = stored(narrow)
    discard(described)

    # Star round.
    other = F.struct(F.col("pos").alias("other_pos"), F.col("gid").alias("other_gid"), F.col("n").alias("other_n"))
    centre = tokens.groupBy("token").agg(F.min(other).alias("c"), F.count("*").alias("m")).where("m > 1").select("token", "c.*")
    stars = tokens.join(centre, "token").where(F.col("gid") != F.col("other_gid")).where(_allowed(threshold))
    votes = stars.groupBy("gid", "other_gid").agg(F.count("*").alias("n_votes"))
    star_pairs = votes.groupBy(F.col("gid").alias("a")).agg(F.max_by("other_gid", F.struct("n_votes", -F.col("other_gid"))).alias("b"))
    member_pairs = members.where("gid <> rep").select(F.col("rep").alias("a"), F.col("gid").alias("b"))
    pairs = star_pairs.unionByName(member_pairs)
    pairs = stored(pairs)
    found = stored(verified(docs, pairs, size, threshold))
    discard(pairs)

    # Full round: what is not in one component yet.
    joined = star_links(found)
    discard(found)
    placed = stored(members.join(joined.withColumnRenamed("a", "rep"), "rep", "left").select("gid", "rep", F.coalesce("b", "rep").alias("component_id")))
    spread = placed.groupBy("gid").agg(F.min("component_id").alias("lowest"), F.max("component_id").alias("highest"))
    marked = tokens.join(spread, "gid")
    # Only shingles that still have two components.
    open_tokens = marked.groupBy("token").agg(F.min("lowest").alias("l"), F.max("highest").alias("h")).where("l <> h").select("token")
    left = stored(marked.join(open_tokens, "token", "left_semi"))
    discard(tokens)
    right = left.select("token", *[F.col(c).alias(f"other_{c}") for c in ("gid", "n", "pos", "lowest", "highest")])
    group_pairs = (
        left.join(right, (left["token"] == right["token"]) & (F.col("gid") < F.col("other_gid")) & _allowed(threshold)
                  & ((F.col("lowest") != F.col("other_lowest")) | (F.col("highest") != F.col("other_highest")) | (F.col("lowest") != F.col("highest"))))
        .select("gid", "other_gid").distinct()
    )
    mixed = spread.where("lowest <> highest").select("gid", F.col("gid").alias("other_gid"))
    one = placed.select("gid", F.col("rep").alias("a"), F.col("component_id").alias("in_a"))
    two = placed.select(F.col("gid").alias("other_gid"), F.col("rep").alias("b"), F.col("component_id").alias("in_b"))
    rest = group_pairs.unionByName(mixed).join(one, "gid").join(two, "other_gid").where("in_a <> in_b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = stored(rest)
    discard(left)
    more = stored(verified(docs, rest, size, threshold))
    discard(rest)

    # One document may stand in several rows with different texts: it ties their classes.
    of_ids = narrow.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", *signature)
    several = of_ids.groupBy("doc_id").agg(*[f(F.struct(*signature)).alias(name) for f, name in ((F.min, "l"), (F.max, "h"))]).where("l <> h")
    ties = of_ids.join(several.select("doc_id"), "doc_id", "left_semi").join(classes, signature).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    # The first round's stars stand for its links: without new links they are the components.
    component = star_links(joined.unionByName(more).unionByName(ties)).withColumnRenamed("a", "rep")
    placed_classes = classes.join(component, "rep", "left").select(*signature, F.coalesce("b", "rep").alias("component_id"))
    return narrow.select("doc_id", *signature).join(placed_classes, signature, "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))).alias("component_id"),
    )

"""Near-duplicate vectors by random-hyperplane sign hashing in several tables, with exact verification.

A table takes the signs of a vector's products with a few random planes as its bucket; only vectors of one label, table
and bucket are compared, in double precision. Equal vectors are one class, counted as many. A bucket is cut into blocks, and
each pair of blocks is one bounded piece of work, so a bucket may be of any size. Such a piece multiplies its blocks and
gives counts and the links of a spanning forest, not pairs. A pair that meets in several tables counts in the first only.

The number of planes follows the number of vectors, so that buckets do not fill up as data grow, and the number of tables
follows from the planes, so that a pair at the threshold is found with the chance ``RECALL``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.components import connected_components
from matchlake.llm.storing import stored

THRESHOLD = 0.98
RECALL = 0.995
LEAST_PLANES = 10
BLOCK = 1024
SEED = 7


def hash_shape(vectors: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """How many planes and tables: a plane per doubling of the vectors, and tables enough for ``recall``."""
    planes = max(LEAST_PLANES, min(60, math.ceil(math.log2(max(2, vectors))) - 3))
    same = (1 - math.acos(threshold) / math.pi) ** planes
    return planes, math.ceil(math.log(1 - recall) / math.log(1 - same))


def classes_of(vectors: DataFrame) -> DataFrame:
    """``label``, ``embedding``, ``least`` (smallest id) and ``copies`` of each distinct usable vector, with a number of its
    own (``rep``, to be stored before use); a vector is usable when it has an id, a label and components, all finite and not
    all zero."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("embedding", lambda x: x != 0)
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(good, F.lit(False)))
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding")).groupBy(
        "label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies")).withColumn("rep", F.monotonically_increasing_id())


def signed(classes: DataFrame, planes: int, tables: int, seed: int = SEED) -> DataFrame:
    """``rep``, ``copies``, ``label``, ``vec`` (unit length, doubles) and ``signs`` (a number per table) of each class.

    The planes of a length of vectors come from a generator seeded with it.
    """
    def sign(batches):
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            vecs, signs = [], []
            for v in batch.column(3):
                x = v.values.to_numpy(zero_copy_only=False)
                x = x / np.abs(x).max()
                x = x / math.sqrt(float(x @ x))
                if len(x) not in made:
                    made[len(x)] = np.random.default_rng([seed, len(x)]).standard_normal((tables * planes, len(x)))
                bits = (made[len(x)] @ x >= 0).reshape(tables, planes)
                signs.append((bits @ (np.int64(1) << np.arange(planes, dtype=np.int64))).astype(np.int64).tobytes())
                vecs.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(vecs, pa.binary()), pa.array(signs, pa.binary())], ["rep", "copies", "label", "vec", "signs"])

    label = classes.schema["label"].dataType.simpleString()
    return classes.select("rep", "copies", "label", "embedding").mapInArrow(sign, f"rep long, copies long, label {label}, vec binary, signs binary")


def _linked(x: np.ndarray, y: np.ndarray, x_signs: np.ndarray, y_signs: np.ndarray, table: int, threshold: float, same: bool):
    """Places (i, j) of the linked pairs of two blocks that no earlier table brings together; a few rows of x at a time."""
    for first in range(0, len(x), 128):
        cosine = x[first : first + 128] @ y.T
        if same:
            cosine = np.where(np.arange(first, first + len(cosine))[:, None] < np.arange(len(y))[None, :], cosine, -2.0)
        i, j = np.nonzero(cosine >= threshold)
        i = i + first
        new = np.ones(len(i), bool)
        for earlier in range(table):
            new &= x_signs[i, earlier] != y_signs[j, earlier]
        yield i[new], j[new]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place reachable from each of ``n`` places by the pairs."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[i], least[j])
        before = least.copy()
        np.minimum.at(least, i, low)
        np.minimum.at(least, j, low)
        least = least[least]
        if (least == before).all():
            return least


def compared(rows: DataFrame, tables: int, threshold: float = THRESHOLD) -> DataFrame:
    """``a``, ``b``, ``n``: links counted for class ``a`` (``b`` NULL), and spanning links a - b (``n`` NULL).

    Buckets of one class are left out before vectors are joined; the others are cut into blocks by a hash of the class.
    """
    spec = "piece string, tab int, side int"
    buckets = rows.select("rep", "label", F.explode(F.sequence(F.lit(0), F.lit(tables - 1))).alias("tab"), "signs").select(
        "rep", "label", "tab", F.substring("signs", F.col("tab") * 8 + 1, F.lit(8)).alias("sign"))
    keys = ["label", "tab", "sign"]
    sizes = buckets.groupBy(*keys).agg(F.count("*").alias("m")).where("m > 1").withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    met = buckets.join(sizes, keys).withColumn("block", F.pmod(F.xxhash64("rep", F.lit(11)), F.col("blocks")).cast("int"))
    pieces = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.concat_ws(":", F.col("label").cast("string"), "tab", F.hex("sign"), F.least("block", "other"), F.greatest("block", "other")).alias("piece"),
        "tab", F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side"), "rep")
    work = pieces.join(rows.select("rep", "copies", "vec", "signs"), "rep").select(*[s.split()[0] for s in spec.split(", ")], "rep", "copies", "vec", "signs")

    def compare(batches):
        def piece(table, side, rep, copies, vec, signs):
            order = np.argsort(rep)
            side, rep, copies = side[order], rep[order], copies[order]
            # Vectors of different length have nothing to compare.
            lengths = np.array([len(v) for v in vec])[order]
            counts, ends = np.zeros(len(rep), np.int64), []
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                x = np.stack([np.frombuffer(vec[order[k]]) for k in at])
                s = np.stack([np.frombuffer(signs[order[k]], np.int64) for k in at])
                same = not side[at].any()
                left, right = (np.arange(len(at)),) * 2 if same else (np.flatnonzero(side[at] == 1), np.flatnonzero(side[at] == 2))
                for i, j in _linked(x[left], x[right], s[left], s[right], table, threshold, same):
                    i, j = at[left[i]], at[right[j]]
                    np.add.at(counts, i, copies[j])
                    np.add.at(counts, j, copies[i])
                    if len(i):
                        # Of these links a spanning forest is kept.
                        places, both = np.unique(np.concatenate([i, j]), return_inverse=True)
                        least = _forest(len(places), both[: len(i)], both[len(i) :])
                        ends.append(np.stack([places, places[least]])[:, places != places[least]])
            some = np.flatnonzero(counts)
            edges = np.unique(np.concatenate(ends, axis=1), axis=1) if ends else np.zeros((2, 0), np.int64)
            a = pa.array(np.concatenate([rep[some], rep[edges[0]]]))
            b = pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(rep[edges[1]])])
            n = pa.concat_arrays([pa.array(counts[some]), pa.nulls(edges.shape[1], pa.int64())])
            return pa.RecordBatch.from_arrays([a, b, n], ["a", "b", "n"])

        now, held = None, []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[0] != now and held:
                    _, tab, side, rep, copies, vec, signs = zip(*held)
                    yield piece(tab[0], np.array(side), np.array(rep), np.array(copies), vec, signs)
                    held = []
                now = row[0]
                held.append(row)
        if held:
            _, tab, side, rep, copies, vec, signs = zip(*held)
            yield piece(tab[0], np.array(side), np.array(rep), np.array(copies), vec, signs)

    return work.repartition("piece").sortWithinPartitions("piece").mapInArrow(compare, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id`` and ``kept`` (the row's id is its component's).

    Two vectors of one label link when their cosine is ``threshold`` or more; links are counted with every row, components
    hold the smallest id reachable. Vectors that are NULL, empty, zero or hold a NULL or non-finite component, or have no
    label, link with nothing. Rows without id have no component and are not kept. Rows that repeat an id link like others.
    Other columns are ignored; no rows give no rows.
    """
    planes, tables = hash_shape(vectors.count(), threshold, recall)
    classes = stored(classes_of(vectors))
    rows = stored(signed(classes, planes, tables))
    found = stored(compared(rows, tables, threshold))
    links = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    # One id may stand in several rows with different vectors: it ties their classes.
    of_rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("of_label"), F.col("embedding").cast("array<double>").alias("of_embedding"))
    placed = of_rows.join(classes, (F.col("label") == F.col("of_label")) & (F.col("embedding") == F.col("of_embedding")), "left").select("vec_id", "rep", "least", "copies")
    placed = stored(placed)
    ties = placed.where("least <> vec_id").select(F.col("vec_id").alias("a"), F.col("least").alias("b"))
    # Links are counted between classes, since an id may stand in several; components are of ids.
    ids = classes.select("rep", "least")
    spanning = found.where("b IS NOT NULL").select("a", "b")
    for end in ("a", "b"):
        spanning = spanning.join(ids.withColumnRenamed("rep", end), end).drop(end).withColumnRenamed("least", end)
    component = connected_components(spanning.select("a", "b").unionByName(ties))
    return placed.join(links, "rep", "left").join(component, placed["vec_id"] == component["node"], "left").select(
        "vec_id", F.when(F.col("rep").isNull(), 0).otherwise(F.col("copies") - 1 + F.coalesce("n", F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

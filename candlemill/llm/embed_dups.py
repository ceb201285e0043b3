"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosines.

Method: vectors are scaled to length 1; a table's bucket is HASHES random projections,
each shifted and cut into cells of WIDTH. Vectors that share a bucket in any of TABLES
tables are compared by cosine in double precision. At cosine 0.9 (distance 0.447) one
projection agrees with probability 0.82, a table with 0.078, any table with 0.98; at
cosine 0.92 with 0.995 and at 0.95 with 0.99999.

Equal vectors are merged first and counted. A pair is counted in the first table
where it meets, which a task can tell from the two vectors alone, so that counts need no table of
pairs: a task returns one row per vector, its count and its root among the vectors seen
there. A bucket of more than BLOCK vectors is dealt in blocks to one task per pair of
blocks; all its links are found, none is emitted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.session import written

from .graph import components

COSINE = 0.9
TABLES, HASHES, WIDTH = 48, 13, 2.0
BLOCK = 2048
SMALL = 64  # vectors of a bucket whose pairs are listed in one go with those of other buckets
BROADCAST_BUCKETS = 100_000
_SEED = 20_11


def projections(dim: int, tables: int = TABLES, hashes: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([_SEED, dim])
    return rng.standard_normal((dim, tables * hashes)), rng.uniform(0, WIDTH, tables * hashes)


def buckets(unit: np.ndarray, tables: int = TABLES, hashes: int = HASHES) -> np.ndarray:
    """Bucket number (a 64-bit mix of the cells) of each unit vector in each table."""
    matrix, shift = projections(unit.shape[1], tables, hashes)
    cells = np.floor((unit @ matrix + shift) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(unit), tables, hashes)
    mixed = np.full((len(unit), tables), unit.shape[1], np.uint64)
    for k in range(hashes):
        mixed = (mixed ^ cells[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
    return mixed.view(np.int64)


def _units(vectors: pa.Array) -> np.ndarray:
    """Rows of one length as unit vectors in double precision."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)  # squares stay finite
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def _all_units(vectors: pa.Array) -> np.ndarray:
    """Unit vectors of any lengths, shorter ones filled up with zeros (a bucket holds one length but for chance)."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    if len(set(lengths.tolist())) <= 1:
        return _units(vectors)
    out = np.zeros((len(vectors), int(lengths.max())))
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        out[rows, :n] = _units(vectors.take(pa.array(rows)))
    return out


def _hasher(tables: int, hashes: int):
    @F.arrow_udf("array<bigint>")
    def run(vector: pa.Array) -> pa.Array:
        lengths = pc.list_value_length(vector).to_numpy(zero_copy_only=False)
        out = np.zeros((len(vector), tables), np.int64)
        for n in np.unique(lengths):
            rows = np.flatnonzero(lengths == n)
            out[rows] = buckets(_units(vector.take(pa.array(rows))), tables, hashes)
        return pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), tables).cast(pa.list_(pa.int64()))

    return run


def linked_pairs(unit: np.ndarray, left: np.ndarray, right: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of left, row of right) at or above the cosine, each pair once."""
    found = []
    for start in range(0, len(left), 512):
        rows = left[start : start + 512]
        i, j = np.nonzero(unit[rows] @ unit[right].T >= cosine)
        found.append((rows[i], right[j]))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    return (i[i < j], j[i < j]) if left is right else (i, j)


def small_pairs(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows inside each of many small groups."""
    pairs = []
    for n in np.unique(sizes[sizes > 1]):
        i, j = np.triu_indices(n, 1)
        first = starts[sizes == n][:, None]
        pairs.append(((first + i).ravel(), (first + j).ravel()))
    if not pairs:
        return np.zeros(0, int), np.zeros(0, int)
    i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
    return i, j


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each position over the pairs."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        open_ = root[i] != root[j]
        i, j = i[open_], j[open_]
    return root


def _compared(rows: pa.Table, starts: np.ndarray, cosine: float, tables: int, hashes: int) -> pa.RecordBatch:
    """Links counted for each vector, and its root, of whole buckets (or pairs of blocks) that begin at `starts`."""
    rep, copies, block, number, low, high = (
        rows[c].to_numpy() for c in ("rep", "copies", "block", "number", "low", "high")
    )
    unit = _all_units(rows["embedding"].combine_chunks())
    sizes = np.diff(np.append(starts, len(rep)))
    small = (sizes <= SMALL) & (low[starts] == high[starts])
    i, j = small_pairs(starts[small], sizes[small])
    near = np.concatenate(
        [np.zeros(0, bool)]
        + [np.einsum("ij,ij->i", unit[i[k : k + 50_000]], unit[j[k : k + 50_000]]) >= cosine for k in range(0, len(i), 50_000)]
    )
    found = [(i[near], j[near])]
    for start, size in zip(starts[~small], sizes[~small], strict=True):
        at = np.arange(start, start + size)
        left = at[block[at] == low[start]]
        right = left if low[start] == high[start] else at[block[at] == high[start]]
        if len(left) and len(right):
            found.append(linked_pairs(unit, left, right, cosine))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    root = local_roots(len(rep), i, j)
    used, place = np.unique(np.concatenate([i, j]), return_inverse=True)
    hashed = buckets(unit[used], tables, hashes) if len(used) else np.zeros((0, tables), np.int64)
    at_i, at_j = place[: len(i)], place[len(i) :]
    for table in range(tables):  # pairs that met in an earlier table are counted there
        new = (number[i] <= table) | (hashed[at_i, table] != hashed[at_j, table])
        i, j, at_i, at_j = i[new], j[new], at_i[new], at_j[new]
    links = (np.bincount(i, copies[j], len(rep)) + np.bincount(j, copies[i], len(rep))).astype(np.int64)
    keep = (links > 0) | (root != np.arange(len(rep)))
    return pa.RecordBatch.from_pydict({"rep": rep[keep], "links": links[keep], "root": rep[root[keep]]})


def _compare(cosine: float, tables: int, hashes: int):
    """Sorted rows stream by; those of a bucket that may go on wait for the next batch."""
    key = ("number", "bucket", "low", "high")

    def run(batches):
        waiting = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if waiting is None else pa.concat_tables([waiting, rows])
            keys = np.stack([rows[c].to_numpy().astype(np.int64) for c in key], axis=1)
            starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1])
            waiting = rows.slice(int(starts[-1]))
            if len(starts) > 1:
                yield _compared(rows.slice(0, int(starts[-1])), starts[:-1], cosine, tables, hashes)
        if waiting is not None and len(waiting):
            yield _compared(waiting, np.zeros(1, int), cosine, tables, hashes)

    return run


def find_duplicates(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    tables: int = TABLES,
    hashes: int = HASHES,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors that are NULL, empty, zero or hold NULL or non-finite parts link with nothing;
    vectors of other lengths don't link. Ids are whole numbers; repeated rows are vectors
    of their own and link with each other. A vector of NULL id links with nothing and
    has a NULL component; it is kept. An empty table gives no rows; other columns are left out.
    """
    rows = embeddings.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{vector_col}`").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.col("vec_id").isNotNull() & F.coalesce(
        (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0), F.lit(False)
    )
    distinct = written(
        rows.where(usable).groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")), "vectors"
    )
    # A vector goes by its smallest id, or by a hash of its own where several vectors have the same.
    shared = written(distinct.groupBy("first").agg(F.count("*").alias("vectors")).where("vectors > 1"), "shared-ids")
    ids_are_shared = not shared.isEmpty()
    if ids_are_shared:
        own = F.when(F.col("vectors").isNotNull(), F.xxhash64("embedding", "first")).otherwise(F.col("first"))
        distinct = written(distinct.join(shared, "first", "left").withColumn("rep", own).drop("vectors"), "vectors")
    else:
        distinct = distinct.withColumn("rep", F.col("first"))
    placed = distinct.select("rep", "copies", "embedding", F.posexplode(_hasher(tables, hashes)("embedding")).alias("number", "bucket"))
    sizes = written(
        placed.groupBy("number", "bucket").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK), "full-buckets"
    ).select("number", "bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_BUCKETS else sizes
    dealt = (
        placed.join(sizes, ["number", "bucket"], "left")
        .withColumn("block", F.coalesce(F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"), F.lit(0)))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1)))
        .select(
            "rep", "copies", "embedding", "block", "number", "bucket",
            F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        )
    )
    found = written(
        dealt.repartition("number", "bucket", "low", "high")
        .sortWithinPartitions("number", "bucket", "low", "high")
        .mapInArrow(_compare(cosine, tables, hashes), "rep bigint, links bigint, root bigint"),
        "links",
    )
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    classes = (
        distinct.join(links, "rep", "left")
        .join(roots.withColumnRenamed("vertex", "rep"), "rep", "left")
        .select("embedding", "first", "copies", "links", F.coalesce("component", "rep").alias("component"))
    )
    if ids_are_shared:  # the smallest key of a component need not be its smallest id then
        named = classes.groupBy("component").agg(F.min("first").alias("named"))
        classes = classes.join(named, "component").withColumn("component", F.col("named")).drop("named")
    good = rows.where(usable).join(classes, "embedding").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.col("component").alias("component_id"),
    )
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

"""Embedding near-dedup by iterative quantisation and multi-index Hamming tables.

1. On a bounded sample of unit vectors (``SAMPLE_ROWS``), principal axes and then, in turns,
   binary codes and the rotation that best maps the axes onto them (orthogonal
   Procrustes) give a rotation with balanced bits. ``ROTATIONS`` are
   learned from different starts, with up to 64 bits each.
2. Every vector is coded. Each 16 bits of a code index one table; vectors of a
   label that agree there are candidates. With the defaults (12 tables) a pair at
   cosine 0.98 misses all tables with a probability under one in a hundred.
3. Candidates are ranked by cosine of the original vectors in double precision. A
   link counts in the first table that holds it, so none counts twice.

Equal vectors of a label are one row with a count, so copies never meet in a table.
A table's bucket of more than ``BUCKET_ROWS`` is dealt into slots, one task per pair
of slots. A task returns the number of links of each vector and a spanning forest of them,
never the pairs.

Defined cases: a null label, or a vector that is null, empty, zero, or holds null or
non-finite components has no links and is its own component. Vectors of other
lengths than the sample's are coded by their first components; only
vectors of one length link. Rows that share a vec_id are one node. A null vec_id is
never a component_id unless alone, and then kept. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ovenplan.llm import common
from ovenplan.session import materialize

MIN_COSINE = 0.98
SAMPLE_ROWS = 10_000
ROTATIONS = 3
TURNS = 30
TABLE_BITS = 16
BUCKET_ROWS = 4096
HOT_VECTORS = 10_000


def learn_rotations(sample: np.ndarray, rotations: int = ROTATIONS, turns: int = TURNS, seed: int = 11):
    """(mean, projections): each projection maps centred unit vectors to values whose signs are the bits."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :64]
    values = centred @ axes
    rng = np.random.default_rng(seed)
    learned = []
    for _ in range(rotations):
        turn = np.linalg.qr(rng.normal(size=(axes.shape[1], axes.shape[1])))[0]
        for _ in range(turns):
            codes = np.where(values @ turn >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(values.T @ codes)
            turn = u @ v
        learned.append(axes @ turn)
    return mean, learned


def codes_of(unit: np.ndarray, mean: np.ndarray, projections: list[np.ndarray]) -> np.ndarray:
    """Table keys, one row per vector: 16 bits of a code each."""
    fitted = np.zeros((len(unit), len(mean)))
    width = min(len(mean), unit.shape[1])
    fitted[:, :width] = unit[:, :width]
    keys = []
    for p in projections:
        bits = (fitted - mean) @ p >= 0
        for i in range(0, bits.shape[1], TABLE_BITS):
            own = bits[:, i : i + TABLE_BITS]
            keys.append(own @ (1 << np.arange(own.shape[1])))
    return np.stack(keys, axis=1).astype(np.int32)


def _usable(vector) -> np.ndarray | None:
    if not vector or None in vector:
        return None
    vector = np.array(vector, dtype=np.float64)
    largest = np.abs(vector).max()
    return vector if np.isfinite(vector).all() and largest > 0 else None


def _unit(vector: np.ndarray) -> np.ndarray:
    vector = vector / np.abs(vector).max()
    return vector / np.linalg.norm(vector)


def _classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, key), and distinct usable vectors (key, label, size, embedding, node, n)."""

    def name(batch):
        keys, sizes = [], []
        for vector, label in zip(batch.column("embedding").to_pylist(), batch.column("label").to_pylist(), strict=True):
            own = _usable(vector) if label is not None else None
            sizes.append(0 if own is None else len(own))
            if own is None:
                keys.append(None)
            else:
                # Zero has two signs; both are one vector.
                keys.append(hashlib.blake2b(repr(label).encode() + b"|" + (own + 0.0).tobytes(), digest_size=16).digest())
        return [*(batch.column(c) for c in ("vec_id", "label", "embedding")), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32())]

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    rows = common.map_batches(
        vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")),
        name,
        f"vec_id {kinds['vec_id']}, label {kinds['label']}, embedding array<double>, key binary, size int",
    )
    rows = materialize(rows, "vectors")
    classes = rows.filter("key is not null").groupBy("key").agg(
        F.first("label").alias("label"), F.first("size").alias("size"), F.first("embedding").alias("embedding"),
        F.min("vec_id").alias("node"), F.count("*").alias("n"),
    )
    # A class without any vec_id still needs a node of its own.
    return rows.select("vec_id", "key"), classes.withColumn("node", F.coalesce("node", F.xxhash64("key")))


def _buckets(classes: DataFrame, mean, projections, bucket_rows: int) -> DataFrame:
    """One row per vector, table and task: (label, size, t, code, a, b, slot, ...)."""

    def code(batch):
        sizes = batch.column("size").to_numpy()
        codes = np.zeros((len(sizes), tables), dtype=np.int32)
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            own = batch.column("embedding").take(pa.array(at)).flatten().to_numpy().reshape(-1, size)
            codes[at] = codes_of(np.stack([_unit(v) for v in own]), mean, projections)
        lists = pa.ListArray.from_arrays(np.arange(0, codes.size + 1, tables, dtype=np.int32), codes.ravel())
        return {n: batch.column(n) for n in names} | {"codes": lists}

    names = classes.columns
    tables = sum(-(-p.shape[1] // TABLE_BITS) for p in projections)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema.fields)
    coded = materialize(common.map_batches(classes, code, ddl + ", codes array<int>"), "vector-codes")
    placed = coded.select("*", F.posexplode("codes").alias("t", "code"))
    bucket = ["label", "size", "t", "code"]
    sizes = placed.groupBy(*bucket).agg(F.count("*").alias("_n")).filter(F.col("_n") > bucket_rows)
    sizes = sizes.withColumn("slots", F.ceil(F.col("_n") / bucket_rows).cast("int")).drop("_n")
    placed = placed.join(sizes, bucket, "left").withColumn("slot", F.coalesce(F.pmod(F.xxhash64("key"), "slots").cast("int"), F.lit(0)))
    placed = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("slots") - 1, F.lit(0)))))
    return placed.withColumn("a", F.least("slot", "o")).withColumn("b", F.greatest("slot", "o")).drop("o", "slots")


def _bucket_links(bucket: pa.Table, min_cosine: float):
    """(key, node, gained, u, v) of one bucket's vectors: copies linked beside it, and its spanning forest."""
    n, size, t = bucket.num_rows, bucket["size"][0].as_py(), bucket["t"][0].as_py()
    column = lambda c: bucket[c].combine_chunks()
    unit = column("embedding").flatten().to_numpy().reshape(n, size)
    unit = unit / np.abs(unit).max(axis=1, keepdims=True)
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    codes = column("codes").flatten().to_numpy().reshape(n, -1)
    slot, many, node = (column(c).to_numpy() for c in ("slot", "n", "node"))
    a, b = bucket["a"][0].as_py(), bucket["b"][0].as_py()
    left, right = (np.arange(n), np.arange(n)) if a == b else (np.flatnonzero(slot == a), np.flatnonzero(slot == b))
    gained, root = np.zeros(n, dtype=np.int64), np.arange(n)
    for lo in range(0, len(left), 512):
        own = left[lo : lo + 512]
        i, j = np.nonzero(unit[own] @ unit[right].T >= min_cosine)
        i, j = own[i], right[j]
        fresh = i < j if a == b else np.ones(len(i), dtype=bool)
        i, j = i[fresh], j[fresh]
        for part in range(0, len(i), 1 << 18):
            p, q = i[part : part + (1 << 18)], j[part : part + (1 << 18)]
            first = ~(codes[p, :t] == codes[q, :t]).any(axis=1)  # else an earlier table has the link
            p, q = p[first], q[first]
            gained += np.bincount(p, many[q], n).astype(np.int64) + np.bincount(q, many[p], n).astype(np.int64)
            root = common.local_roots(n, p, q, root)
    some = np.flatnonzero(gained)
    return column("key").take(pa.array(some)), gained[some], node[some], node[root[some]]


def links_of(buckets: DataFrame, min_cosine: float) -> DataFrame:
    """(key, gained, u, v) over all buckets; buckets follow one another in a sorted partition."""
    keys = ["label", "size", "t", "code", "a", "b"]

    def run(batches):
        held, at = [], None

        def flush():
            if sum(x.num_rows for x in held) > 1:
                found = _bucket_links(pa.Table.from_batches(held), min_cosine)
                if len(found[1]):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["key", "gained", "u", "v"])

        for batch in batches:
            values = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            start = 0
            for i in range(1, len(values) + 1):
                if i == len(values) or values[i] != values[start]:
                    if values[start] != at:
                        yield from flush()
                        held, at = [], values[start]
                    held.append(batch.slice(start, i - start))
                    start = i
        yield from flush()

    placed = buckets.repartition(*keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(run, "key binary, gained long, u long, v long")


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label)."""
    rows, classes = _classes(vectors)
    classes = materialize(classes, "vector-classes")
    sample = classes.orderBy(F.xxhash64("key")).limit(SAMPLE_ROWS).select("embedding").collect()
    sizes = [len(r.embedding) for r in sample]
    usual = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 1
    sample = np.array([_unit(np.array(r.embedding)) for r in sample if len(r.embedding) == usual]).reshape(-1, usual)
    mean, projections = learn_rotations(sample) if len(sample) else (np.zeros(1), [np.ones((1, 1))])
    found = materialize(links_of(_buckets(classes, mean, projections, bucket_rows), min_cosine), "vector-links")
    gained = found.groupBy("key").agg(F.sum("gained").alias("gained"))
    member = common.connected_components(found.filter("u <> v").select("u", "v"), "vector-components")
    known = classes.select("key", "node", "n").join(gained, "key", "left").join(member, "node", "left")
    known = known.withColumn("component_id", F.coalesce("root", "node"))
    known = materialize(known.select("key", "component_id", "n", (F.col("n") - 1 + F.coalesce("gained", F.lit(0))).alias("n_links")), "vector-known")
    hot = known.orderBy(F.desc("n"), "key").limit(HOT_VECTORS)
    both = common.salted_join(rows, known.drop("n"), "key", hot, F.xxhash64("vec_id"))
    component = F.coalesce("component_id", "vec_id")
    return both.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def op3_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))

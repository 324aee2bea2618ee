"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ovenplan.session import materialize

#: ASCII white space, the only characters that separate words in these operators.
ASCII_WS = b" \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def salted_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, salt: Column, ways: int = 32) -> DataFrame:
    """Left join of ``left`` to ``right`` (one row per ``key``) that spreads the keys listed in ``hot``.

    ``hot`` is a frame of at most a fixed number of keys (the caller takes a
    top-k by count), so it may be broadcast. Rows of a hot key go to ``ways``
    join keys by ``salt``; the one matching row of ``right`` is repeated for each.
    """
    hot = F.broadcast(hot.select(key).withColumn("_hot", F.lit(True)))
    a = left.join(hot, key, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(salt, F.lit(ways))).otherwise(F.lit(0)).cast("int")
    )
    b = right.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0))))
    )
    return a.drop("_hot").join(b.drop("_hot"), [key, "_salt"], "left").drop("_salt")


def local_roots(n: int, a: np.ndarray, b: np.ndarray, parent: np.ndarray | None = None) -> np.ndarray:
    """Smallest member of each component of the graph on ``range(n)`` with edges ``a``-``b``.

    Hooks larger roots onto smaller ones and jumps pointers, all in arrays.
    ``parent`` carries the components found so far, so edges may come in blocks.
    """
    parent = np.arange(n) if parent is None else parent
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v long); root is the smallest node reachable.

    Alternating large-star and small-star steps; each step is two hash joins
    or aggregations over the remaining links, written to the shared folder, so
    lineage stays one step deep and a lost executor re-reads files. The per-node
    minima are written before the join, so that both of its sides are plain
    exchanges and adaptive execution can split a node with very many links.
    """
    links = materialize(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), name
    )
    before = None
    while True:
        # Large star: every larger neighbour of u is linked to the smallest node around u.
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name)
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u <> v").distinct(), name)
        # Small star: the smaller neighbours of u, and u itself, are linked to the smallest of them.
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), name)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = materialize(
            small.unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), name
        )
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionAll(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], list | dict], schema: str | T.StructType, rows: int = 1000
) -> DataFrame:
    """``fn`` over Arrow batches of ``rows`` rows at most; it returns the arrays or lists of one result batch, by column.

    Columns that ``fn`` passes on stay Arrow arrays, so null integers, nested
    values and times come through unchanged.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = schema.names

    def task(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                columns = fn(batch.slice(i, rows))
                if isinstance(columns, dict):
                    columns = [columns[n] for n in names]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names
                )

    return df.mapInArrow(task, schema)

"""Near-duplicate vectors by random-hyperplane hashing.

The signs of a vector's products with random hyperplanes are its code in one
table. Vectors of a label that share a code in any table are candidates, and a
pair is linked if its cosine in double precision reaches the limit. Buckets
are dealt out in blocks of bounded size: every two blocks of a bucket meet in
one task, which computes their cosines as a matrix product and returns, for
each vector, how many links it found, and links that connect the same vectors
as all found ones do, but not every pair. A pair is counted in the first table
only in which it shares a code.

Equal vectors of one label are one class with a number of copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodlens.llm.components import connected_components
from periodlens.session import pin


def plan_tables(rows: int, limit: float, recall: float, bucket: int = 256) -> tuple[int, int]:
    """Bits of a code, so that a bucket of unlike vectors has about ``bucket`` of ``rows``, and the number of tables
    with which a pair just at the limit shares a code in one of them with probability ``recall``."""
    bits = int(np.clip(np.ceil(np.log2(max(2, rows) / bucket)), 6, 62))
    same = (1 - np.arccos(limit) / np.pi) ** bits
    return bits, int(np.ceil(np.log(1 - recall) / np.log(1 - same)))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component to 0.5 or more and below 1.

    No other digit changes, and squares neither overflow nor vanish.
    """
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _hyperplanes(tables: int, bits: int, size: int) -> np.ndarray:
    return np.random.default_rng(size).normal(size=(tables * bits, size))


def _coded(vectors: DataFrame, bits: int, tables: int) -> DataFrame:
    """Add ``codes``, one for each table; a row's vector is ``embedding``, an array of doubles."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = np.int64(1) << np.arange(bits, dtype=np.int64)
        for batch in batches:
            rows = batch["embedding"].to_numpy(zero_copy_only=False)
            codes = np.zeros((len(rows), tables), dtype=np.int64)
            sizes = np.array([len(row) for row in rows])
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                if size not in planes:
                    planes[size] = _hyperplanes(tables, bits, int(size)).T
                for at in range(0, len(own), 2048):
                    some = own[at : at + 2048]
                    signs = _scaled(np.stack([rows[i] for i in some])) @ planes[size] > 0
                    codes[some] = signs.reshape(len(some), tables, bits) @ weights
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(codes), pa.list_(pa.int64()))], [*batch.schema.names, "codes"]
            )

    return vectors.mapInArrow(
        code, T.StructType([*vectors.schema.fields, T.StructField("codes", T.ArrayType(T.LongType()))])
    )


def _roots(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index that each of 0 .. size - 1 is connected with."""
    root = np.arange(size)
    while True:
        before = root.copy()
        np.minimum.at(root, left, root[right])
        np.minimum.at(root, right, root[left])
        root = root[root]
        if (root == before).all():
            return root


def _links_in(rows: pd.DataFrame, table: int, limit: float) -> pd.DataFrame:
    """Links of one meeting of two blocks: for each class its number of linked copies, and a class it hangs on."""
    x = _scaled(np.stack(rows["embedding"].to_numpy()))
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    codes = np.stack(rows["codes"].to_numpy())
    copies, node = rows["copies"].to_numpy(), rows["node"].to_numpy()
    first, second = np.flatnonzero(rows["side"].to_numpy() != 2), np.flatnonzero(rows["side"].to_numpy() != 1)
    degree = np.zeros(len(rows), dtype=np.int64)
    left, right = [], []
    # A margin of rounding is taken first, then the products are recomputed one by one.
    a, b = np.nonzero(x[first] @ x[second].T >= limit - 1e-9)
    a, b = first[a], second[b]
    own = a < b if rows["side"].iloc[0] == 0 else slice(None)
    a, b = a[own], b[own]
    for at in range(0, len(a), 1 << 16):
        i, j = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
        linked = np.einsum("ij,ij->i", x[i], x[j]) >= limit
        if table:
            linked &= ~(codes[i, :table] == codes[j, :table]).any(axis=1)
        i, j = i[linked], j[linked]
        np.add.at(degree, i, copies[j])
        np.add.at(degree, j, copies[i])
        left.append(i)
        right.append(j)
    root = _roots(len(rows), np.concatenate([np.zeros(0, np.int64), *left]), np.concatenate([np.zeros(0, np.int64), *right]))
    found = np.flatnonzero(degree)
    return pd.DataFrame({"node": node[found], "links": degree[found], "root": node[root[found]]})


def near_duplicates(
    vectors: DataFrame, limit: float = 0.93, recall: float = 0.9999, block: int = 512
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for each row of ``vec_id``, ``embedding``, ``label``.

    Links join vectors of equal, non-null label and equal length with cosine
    ``limit`` or more. Vectors that are null, empty, zero or hold null or
    non-finite components, and rows without label, link with nothing. Equal
    vectors are linked with each other. A row without vec_id takes part in
    nothing: no links, null component, kept. Rows that repeat a vec_id count
    as rows of their own. Other columns are ignored.
    """
    plain = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    fit = (
        F.col("label").isNotNull()
        & F.col("vec_id").isNotNull()
        & (F.size("embedding") > 0)
        & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    usable = F.coalesce(fit, F.lit(False))
    # -0.0 and 0.0 are one value.
    whole = F.transform("embedding", lambda x: x + F.lit(0.0))
    digest = F.sha2(F.to_json(F.struct("label", whole.alias("v"))).cast("binary"), 256)
    rows = plain.select("vec_id", F.when(usable, digest).alias("digest"))
    classes = pin(
        plain.where(usable)
        .select("vec_id", "label", "embedding", digest.alias("digest"))
        .groupBy("digest")
        .agg(
            F.min("vec_id").alias("first_id"),
            F.count("*").alias("copies"),
            F.any_value("label").alias("label"),
            F.any_value("embedding").alias("embedding"),
        ),
        "classes",
    )
    classes = classes.withColumnRenamed("digest", "node")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan_tables(largest, limit, recall)
    coded = pin(_coded(classes.select("node", "label", "copies", "embedding"), bits, tables), "coded")
    cells = coded.select("node", "label", F.size("embedding").alias("size"), F.posexplode("codes").alias("table", "code"))
    bucket = ["label", "size", "table", "code"]
    held = pin(cells.groupBy(*bucket).agg(F.count("*").alias("held")).where("held > 1"), "buckets")
    blocks = F.ceil(F.col("held") / block).cast("int")
    placed = cells.join(held, bucket).select(
        "node", *bucket, blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block")
    )
    # Every two blocks of a bucket meet once; side 0 marks a block that meets itself.
    meetings = placed.withColumn(
        "meeting",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.col("blocks") - 1),
                lambda other: F.struct(
                    F.least("block", other).alias("low"),
                    F.greatest("block", other).alias("high"),
                    F.when(other == F.col("block"), 0).when(other > F.col("block"), 1).otherwise(2).alias("side"),
                ),
            )
        ),
    ).select("node", *bucket, "meeting.*")

    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        if rows["side"].nunique() == 1 and rows["side"].iloc[0] != 0:
            return pd.DataFrame({"node": [], "links": [], "root": []})
        return _links_in(rows.sort_values("node"), int(key[2]), limit)

    found = pin(
        meetings.join(coded.select("node", "copies", "embedding", "codes"), "node")
        .groupBy(*bucket, "low", "high")
        .applyInPandas(meet, "node string, links long, root string"),
        "found",
    )
    degrees = found.groupBy("node").agg(F.sum("links").alias("links"))
    components = pin(connected_components(found, "node", "root"), "components")
    smallest = (
        components.join(classes.select("node", "first_id"), "node")
        .groupBy("component")
        .agg(F.min("first_id").alias("smallest"))
    )
    of_class = pin(
        classes.select("node", "first_id", "copies")
        .join(degrees, "node", "left")
        .join(components, "node", "left")
        .join(smallest, "component", "left")
        .select(
            F.col("node").alias("_node"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("_links"),
            F.coalesce("smallest", "first_id").alias("_component"),
        ),
        "class-components",
    )
    component = F.coalesce("_component", "vec_id")
    return rows.join(of_class, F.col("digest") == F.col("_node"), "left").select(
        "vec_id",
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )

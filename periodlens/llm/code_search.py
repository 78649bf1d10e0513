"""Exact nearest neighbours of binary codes by incremental multi-index hashing.

A 64-bit code is cut into segments, and the index holds every segment's value.
Two codes at distance ``d`` or less over ``s`` segments have a segment in
which they differ in at most ``d / s`` bits. So a query looks up its segments
with 0, 1, 2, ... flipped bits. With radius ``r`` in the first ``j`` segments
and ``r - 1`` in the others it has met every code at a distance below
``s * r + j``. It is done when its k-th verified distance is below that; the
others go on. Candidates beyond the k-th distance found so far are dropped in
the join itself; the first segment alone gives the first such bound.

Equal codes are one entry with its smallest ids, so copies are not multiplied.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodlens.session import pin

BITS = 64


def binary_code(embedding: Column) -> Column:
    """A 64-bit code: bit ``i`` is set where the sum of the components ``i``, ``i + 64``, ... is positive.

    Null for a null or empty vector and for one with null or non-finite components.
    """
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def packed(values: Column) -> Column:
        bits = F.transform(values, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))).otherwise(F.lit(0).cast("long")))
        return F.aggregate(bits, F.lit(0).cast("long"), lambda total, bit: total.bitwiseOR(bit))

    folded = F.transform(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        lambda i: F.aggregate(
            F.filter(embedding, lambda x, j: j % BITS == i), F.lit(0.0), lambda total, x: total + x.cast("double")
        ),
    )
    code = F.when(F.size(embedding) <= BITS, packed(embedding)).otherwise(packed(folded))
    return F.when((F.size(embedding) > 0) & ~bad, code)


def segment_width(codes: int) -> int:
    """Bits of a segment: about 2**8 codes share a value, so that look-ups do not outnumber what they find."""
    return int(min(16, max(8, round(math.log2(max(1, codes))) - 8)))


def _segments(code: Column, width: int) -> list[Column]:
    mask = F.lit((1 << width) - 1).cast("long")
    return [F.shiftrightunsigned(code, at).bitwiseAND(mask) for at in range(0, BITS, width)]


def _first_met_here(difference: Column, width: int, radius: int) -> Column:
    """True in one segment only for each pair: the first one of those with the smallest distance, if that is ``radius``."""
    whole = F.lit(True)
    for i, part in enumerate(_segments(difference, width)):
        apart = F.bit_count(part)
        whole = whole & ((apart > radius) | ((F.col("segment") <= i) & (apart == radius)))
    return whole


def _steps(width: int, count: int) -> list[tuple[int, int, int]]:
    """Radius and first and last segment of each step: one segment, the others, then halves."""
    half = (count - 1) // 2
    return [(0, 0, 0), (0, 1, count - 1)] + [
        (radius, *part) for radius in range(1, width + 1) for part in ((0, half), (half + 1, count - 1))
    ]


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``distance``: the k nearest of ``rows`` to each of ``queries``.

    Both have ``vec_id`` and ``code``. Neighbours are ordered by Hamming
    distance, then vec_id; a query is not its own neighbour. Rows with a null
    in either column take no part; repeats of a row count once. Fewer than k
    rows come back if there are fewer others. Other columns are ignored.
    """
    known = rows.select("vec_id", "code").where("vec_id IS NOT NULL AND code IS NOT NULL").distinct()
    place = F.row_number().over(Window.partitionBy("code").orderBy("vec_id"))
    codes = pin(
        known.withColumn("place", place)
        .where(F.col("place") <= k + 1)
        .groupBy("code")
        .agg(F.collect_list("vec_id").alias("ids")),
        "codes",
    )
    width = segment_width(codes.count())
    count = -(-BITS // width)
    index = pin(
        codes.select("code", "ids", F.posexplode(F.array(*_segments(F.col("code"), width))).alias("segment", "value")),
        "index",
    )
    asked = queries.select("vec_id", "code").where("vec_id IS NOT NULL AND code IS NOT NULL").distinct()
    active = asked.select(F.col("code").alias("query")).distinct().withColumn("bound", F.lit(BITS))
    best: DataFrame | None = None
    for radius, first, last in _steps(width, count):
        parts = F.posexplode(F.array(*_segments(F.col("query"), width))).alias("segment", "own")
        flips = F.array(*[F.lit(sum(1 << i for i in bits)).cast("long") for bits in itertools.combinations(range(width), radius)])
        probes = (
            active.select("query", "bound", parts)
            .where(F.col("segment").between(first, last))
            .select("query", "bound", "segment", F.explode(F.transform(flips, lambda m: m.bitwiseXOR(F.col("own")))).alias("value"))
        )
        difference = F.col("query").bitwiseXOR(F.col("code"))
        # Probes unfold from a few rows, so their size is not known before: without the hint they may be broadcast.
        met = probes.hint("merge").join(
            index,
            (probes["segment"] == index["segment"])
            & (probes["value"] == index["value"])
            & (F.bit_count(difference) <= F.col("bound")),
        ).select("query", "code", "ids", probes["segment"].alias("segment"))
        found = (
            met.where(_first_met_here(difference, width, radius))
            .select("query", F.bit_count(difference).alias("distance"), F.explode("ids").alias("vec_id"))
        )
        if best is not None:
            found = found.unionByName(best.select("query", F.explode("near").alias("x")).select("query", "x.distance", "x.vec_id"))
        order = F.row_number().over(Window.partitionBy("query").orderBy("distance", "vec_id"))
        best = pin(
            found.withColumn("place", order)
            .where(F.col("place") <= k + 1)
            .groupBy("query")
            .agg(F.array_sort(F.collect_list(F.struct("distance", "vec_id"))).alias("near")),
            "best",
        )
        covered = count * radius + last
        kth = F.when(F.size("near") > k, F.element_at("near", k + 1)["distance"]).otherwise(BITS)
        state = active.select("query").join(best, "query", "left").select("query", F.coalesce(kth, F.lit(BITS)).alias("bound"))
        active = pin(state.where(F.col("bound") > covered), "active")
        if active.isEmpty():
            break
    others = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    return (
        asked.select(F.col("vec_id").alias("query_id"), "code")
        .join(best, F.col("code") == F.col("query"))
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("place", "x"))
        .select("query_id", (F.col("place") + 1).alias("rank"), "x.vec_id", F.col("x.distance").cast("int").alias("distance"))
    )


def oracle_sql(k: int = 10) -> str:
    """The registered query in SQL for DuckDB, for vectors of 64 components."""
    return f"""
WITH codes AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: (x > 0)) AS bits FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id AS vec_id,
    len(list_filter(range(1, len(q.bits) + 1), lambda i: q.bits[i] <> r.bits[i]))::INTEGER AS distance
  FROM codes q JOIN codes r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs)
WHERE rank <= {k}
"""

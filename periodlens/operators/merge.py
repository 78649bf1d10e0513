"""Upsert, insert-if-absent and surrogate keys without a table format.

All functions return the merged table as a new DataFrame; the caller writes it
to a new version (see ``sources.tables``), never over the files being read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodlens.operators.ordering import rank_rows
from periodlens.session import pin


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key in the given order; rows equal in it are taken by their other columns.

    An aggregation, so copies of one key collapse before the shuffle. Each
    column is held once: the least row is the least by its order columns, which
    come first.
    """
    named = [c for c in order if isinstance(c, str)]
    parts = [F.col(c) if isinstance(c, str) else c.alias(f"_order_{i}") for i, c in enumerate(order)]
    rest = [F.col(c) for c in df.columns if c not in named and c not in keys]
    row = F.struct(*parts, *rest)
    kept = df.groupBy(*keys).agg(F.min(row).alias("_row"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise if a key occurs twice."""
    example = duplicate_keys(df, keys).head(1)
    if example:
        raise ValueError(f"{what}: duplicate key {example[0].asDict()}")


def _highest_key(target: DataFrame, key: str) -> int:
    return target.agg(F.max(key)).first()[0] or 0


def _number_new_rows(new: DataFrame, key: str, order: Sequence[str], highest: int) -> DataFrame:
    numbered = rank_rows(new, [], list(order), "_number")
    return numbered.withColumn(key, F.lit(highest) + F.col("_number")).drop("_number")


def absent_rows(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    surrogate: str | None = None,
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Rows of ``incoming`` whose key the target lacks, the first of each key, with the target's columns."""
    # Files are resent whole, so most rows are known: they go before the others are reduced, on the same exchange.
    unknown = incoming.join(target.select(*keys), list(keys), "left_anti").select(*incoming.columns)
    new = first_per_key(unknown, keys, order or [c for c in incoming.columns if c not in keys])
    if surrogate:
        new = _number_new_rows(new, surrogate, keys, _highest_key(target, surrogate))
    return new.select(*[F.col(f.name).cast(f.dataType) for f in target.schema.fields])


def insert_if_absent(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    surrogate: str | None = None,
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Append rows whose key the target lacks; the first row of a key wins.

    Rows present in the target are never changed.
    """
    return target.unionByName(absent_rows(target, incoming, keys, surrogate, order))


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    on_insert: Mapping[str, Column] | None = None,
    on_update: Mapping[str, Column] | None = None,
    surrogate: str | None = None,
    highest: int | None = None,
) -> DataFrame:
    """Overwrite rows of known keys, append the rest.

    ``incoming`` must be unique on the keys: a key that comes twice fails the
    job that reads the result, with the key in its message. Its columns replace
    the target's, NULLs included; target columns it lacks are kept.
    ``on_insert`` and ``on_update`` give the remaining columns of new and of
    changed rows. One full outer join, each side exchanged once; the copies of a
    key are counted on the exchange and sort of the join.
    """
    on_insert, on_update = dict(on_insert or {}), dict(on_update or {})
    copies = F.count("*").over(Window.partitionBy(*keys))
    shown = F.to_json(F.struct(*keys))
    checked = F.when(copies > 1, F.raise_error(F.concat(F.lit("duplicate key "), shown)).cast("boolean")).otherwise(True)
    changes = incoming.withColumn("_once", checked).select(
        F.struct(*incoming.columns, "_once").alias("_new"), *[F.col(k).alias(f"_key_{k}") for k in keys]
    )
    matches = reduce(and_, [F.col(k) == F.col(f"_key_{k}") for k in keys])
    is_changed = F.col("_new").isNotNull()
    is_known = F.col("_known").isNotNull()
    merged = []
    for field in target.schema.fields:
        name, kind = field.name, field.dataType
        if name in incoming.columns and name != surrogate:
            value = F.when(is_changed, F.col(f"_new.{name}")).otherwise(F.col(name))
        else:
            value = F.when(is_changed & is_known, on_update.get(name, F.col(name)))
            value = value.when(is_changed, on_insert.get(name, F.lit(None))).otherwise(F.col(name))
        merged.append(value.cast(kind).alias(name))
    once = F.coalesce(F.col("_new._once"), F.lit(True))
    joined = target.withColumn("_known", F.lit(True)).join(changes, matches, "full_outer").where(once)
    if not surrogate:
        return joined.select(*merged)
    # New rows are numbered after the others, so the join is written once and read twice.
    rows = pin(joined.select(*merged, is_known.alias("_is_known")), "upsert")
    known, new = (rows.where(side).drop("_is_known") for side in ("_is_known", "NOT _is_known"))
    highest = _highest_key(target, surrogate) if highest is None else highest
    return known.unionByName(_number_new_rows(new.drop(surrogate), surrogate, keys, highest))

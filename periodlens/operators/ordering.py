"""Ranks, running totals and exact quantiles over groups of any size.

A window over a whole group puts that group into one task. A model's yearly
validation set or a feature column can hold a third of all rows, so these
operators sort by range over the whole cluster instead, number the rows inside
each sorted slice, and add the totals of the slices before it. Sort keys must
be unique within a group, then no slice can grow hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodlens.session import pin

# monotonically_increasing_id keeps the slice number above these bits.
_SLICE_BITS = 33


def _pin_sorted(df: DataFrame, groups: Sequence[str], order: Sequence[Column | str], label: str) -> DataFrame:
    position = F.col("_position")
    placed = df.sort(*groups, *order).withColumn("_position", F.monotonically_increasing_id())
    return (
        pin(placed, label)
        .withColumn("_slice", F.shiftright(position, _SLICE_BITS))
        .withColumn("_offset", position.bitwiseAND(F.lit((1 << _SLICE_BITS) - 1)))
        .drop("_position")
    )


def _with_slice_totals(
    placed: DataFrame, groups: Sequence[str], totals: Mapping[str, Column]
) -> DataFrame:
    """Join to each row what its group holds in earlier slices and in all.

    One row per (slice, group): at most slices + groups rows, and at most one
    per slice in each window here. They are pinned, so the join back is a
    broadcast while they are small and a shuffle on (slice, group) beyond.
    """
    earlier = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    slices = placed.groupBy("_slice", *groups).agg(
        F.min("_offset").alias("_first"),
        *[F.sum(value).alias(f"_in_{name}") for name, value in totals.items()],
    )
    renamed = {group: f"_group_{i}" for i, group in enumerate(groups)}
    slices = slices.select(
        F.col("_slice").alias("_slice_no"),
        "_first",
        *[F.col(group).alias(alias) for group, alias in renamed.items()],
        *[
            column
            for name in totals
            for column in (
                F.coalesce(F.sum(f"_in_{name}").over(earlier), F.lit(0)).alias(f"_before_{name}"),
                F.sum(f"_in_{name}").over(whole).alias(f"_all_{name}"),
            )
        ],
    )
    slices = pin(slices, "slices")
    condition = F.col("_slice") == F.col("_slice_no")
    for group, alias in renamed.items():
        condition = condition & F.col(group).eqNullSafe(F.col(alias))
    return placed.join(slices, condition).drop("_slice_no", *renamed.values())


def rank_rows(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column | str],
    rank_name: str = "row_rank",
    size_name: str | None = None,
) -> DataFrame:
    """Row number per group, and the group size if ``size_name`` is given."""
    placed = _with_slice_totals(_pin_sorted(df, groups, order, "rank"), groups, {"rows": F.lit(1)})
    rank = F.col("_before_rows") + F.col("_offset") - F.col("_first") + 1
    columns = [*df.columns, rank.cast("long").alias(rank_name)]
    if size_name:
        columns.append(F.col("_all_rows").cast("long").alias(size_name))
    return placed.select(*columns)


def running_totals(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column | str],
    totals: Mapping[str, str],
) -> DataFrame:
    """Running sums per group; ``totals`` maps a new name to a value column.

    Also adds ``<name>_all``, the sum over the whole group.
    """
    local = (
        Window.partitionBy("_slice", *groups)
        .orderBy("_offset")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    values = {name: F.col(source) for name, source in totals.items()}
    placed = _with_slice_totals(_pin_sorted(df, groups, order, "totals"), groups, values)
    return placed.select(
        *df.columns,
        *[(F.col(f"_before_{name}") + F.sum(value).over(local)).alias(name) for name, value in values.items()],
        *[F.col(f"_all_{name}").alias(f"{name}_all") for name in values],
    )


def count_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Copies of each value per column, in one pass: ``name``, ``value``, ``copies``.

    Counted map-side, so a hot value such as an imputed zero costs one row.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return (
        df.select(*keep, F.explode(pairs).alias("pair"))
        .select(*keep, "pair.name", "pair.value")
        .where(F.col("value").isNotNull())
        .groupBy(*keep, "name", "value")
        .agg(F.count("*").alias("copies"))
    )


def exact_quantiles(
    counted: DataFrame, groups: Sequence[str], fractions: Mapping[str, float], copies: Sequence[str] = ("copies",)
) -> DataFrame:
    """Linear-interpolated quantiles of counted values, one row per group.

    ``counted`` holds ``value`` and its number of copies; ``fractions`` names
    the result columns. A value may come in a few rows of one group. With
    several ``copies`` columns the quantiles of each are found on one sort, in
    columns named ``<copies>_<fraction>``; a column without copies gives NULL.
    """
    ranked = running_totals(counted, groups, ["value"], {f"upto_{name}": name for name in copies})
    picked, results = [], {}
    for name in copies:
        upto, total = F.col(f"upto_{name}"), F.col(f"upto_{name}_all")
        for label, fraction in fractions.items():
            own = label if len(copies) == 1 else f"{name}_{label}"
            position = F.lit(float(fraction)) * (total - 1)
            for side, index in (("low", F.floor(position)), ("high", F.ceil(position))):
                holds = (upto - F.col(name) <= index) & (index < upto)
                picked.append(F.max(F.when(holds, F.col("value"))).alias(f"{own}_{side}"))
            picked.append(F.max(position - F.floor(position)).alias(f"{own}_part"))
            low, high = F.col(f"{own}_low"), F.col(f"{own}_high")
            results[own] = low + (high - low) * F.col(f"{own}_part")
    found = ranked.groupBy(*groups).agg(*picked)
    return found.select(*groups, *[value.alias(name) for name, value in results.items()])

"""Near-duplicate documents by SetSketch registers.

A document is the set of its 5-word shingles. Register ``i`` of its sketch is
``floor(1 - log_b x)`` of the smallest of exponentially distributed hash values
of the shingles, cut to 0 .. 65535: registers of two parts of a set merge by
their maximum, and two sets agree in a register about as often as their
similarity. Bands of four registers find candidates; the similarity of a
candidate pair is first estimated from all registers by maximum likelihood,
and only then confirmed on the full sets.

Documents of equal sets are one class, so exact copies are never compared. In
each bucket of a band first only the smallest class meets the others. What is
linked then is one component, and only pairs across components of a bucket are
compared afterwards: a large group of near copies costs one comparison each,
not all pairs. A bucket with many components, such as copies just too far apart
to be linked, is dealt out in blocks; every two blocks meet in one task, which
compares registers and sets in place and returns links that join components,
not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodlens.llm.common import hash_words, mix64, sliced, texts_as_bytes, tidy, with_columns_from_arrow
from periodlens.llm.components import connected_components
from periodlens.session import pin

WIDTH = 5
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 65_535
_FILTER_BITS = 26
_CROWD, _BLOCK = 64, 512

_seeds = mix64(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_factors = mix64(_seeds) | np.uint64(1)
_places = mix64(np.arange(101, 101 + WIDTH, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; the whole sequence where it has fewer words."""
    words, bounds = hash_words(texts)
    rolled = np.zeros(max(0, len(words) - WIDTH + 1), dtype=np.uint64)
    for i, place in enumerate(_places):
        rolled += words[i : i + len(rolled)] * place
    rolled = mix64(rolled)
    sets = []
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if last - first >= WIDTH:
            sets.append(np.unique(rolled[first : last - WIDTH + 1]))
        elif last > first:
            short = (words[first:last] * _places[: last - first]).sum(dtype=np.uint64)
            sets.append(mix64(np.array([short + np.uint64(last - first)], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_keys(sets: list[np.ndarray]) -> list[bytes | None]:
    """A 128-bit digest of each set, None for an empty one."""
    salt = np.uint64(0x5851F42D4C957F2D)
    return [
        np.array([s.sum(dtype=np.uint64) + np.uint64(len(s)), mix64(s ^ salt).sum(dtype=np.uint64)], dtype=">u8").tobytes()
        if len(s)
        else None
        for s in sets
    ]


def sketches(sets: list[np.ndarray], piece: int = 1 << 16) -> np.ndarray:
    """Registers of sets, a row for each; zeros for an empty set."""
    least = np.full((len(sets), REGISTERS), np.iinfo(np.uint64).max, dtype=np.uint64)
    waiting: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush() -> None:
        if not waiting:
            return
        values = np.concatenate([part for _, part in waiting])
        starts = np.cumsum([0, *(len(part) for _, part in waiting[:-1])])
        rows = np.array([row for row, _ in waiting])
        scratch = np.empty_like(values)
        for i in range(REGISTERS):
            np.bitwise_xor(values, _seeds[i], out=scratch)
            np.multiply(scratch, _factors[i], out=scratch)
            found = np.minimum.reduceat(scratch, starts)
            np.minimum.at(least[:, i], rows, found)
        waiting.clear()

    for row, values in enumerate(sets):
        for at in range(0, len(values), piece):
            part = values[at : at + piece]
            waiting.append((row, part))
            held += len(part)
            if held >= piece:
                flush()
                held = 0
    flush()
    smallest = -np.log1p(-(least.astype(np.float64) / 2.0**64).clip(2.0**-64, 1 - 2.0**-53)) / RATE
    registers = np.floor(1 - np.log(smallest) / np.log(BASE)).clip(0, TOP - 1) + 1
    registers[[i for i, s in enumerate(sets) if not len(s)]] = 0
    return registers.astype(np.uint16)


def _as_bands(registers: np.ndarray) -> np.ndarray:
    wide = registers.astype(np.uint64).reshape(len(registers), BANDS, ROWS)
    return (wide[:, :, 0] << np.uint64(48) | wide[:, :, 1] << np.uint64(32) | wide[:, :, 2] << np.uint64(16) | wide[:, :, 3]).view(np.int64)


def _as_registers(bands: np.ndarray) -> np.ndarray:
    wide = bands.view(np.uint64)
    parts = [(wide >> np.uint64(shift)) & np.uint64(0xFFFF) for shift in (48, 32, 16, 0)]
    return np.stack(parts, axis=2).reshape(len(bands), REGISTERS)


def likely_similarity(left: np.ndarray, right: np.ndarray, left_size: np.ndarray, right_size: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches with known set sizes."""
    above, below = (left > right).sum(axis=1), (left < right).sum(axis=1)
    equal = left.shape[1] - above - below
    u = left_size / (left_size + right_size)
    v = 1 - u

    def exceeds(x: np.ndarray) -> np.ndarray:
        return (-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)).clip(1e-12, 1)

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = exceeds(u - v * j), exceeds(v - u * j)
        return above * np.log(p) + below * np.log(q) + equal * np.log((1 - p - q).clip(1e-12, 1))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        a, b = low + (high - low) * 0.382, low + (high - low) * 0.618
        better = likelihood(a) > likelihood(b)
        low, high = np.where(better, low, a), np.where(better, b, high)
    return (low + high) / 2


SKETCH = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_key", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


def _list_array(values: np.ndarray) -> pa.Array:
    rows, width = values.shape
    return pa.ListArray.from_arrays(np.arange(0, rows * width + 1, width, dtype=np.int32), pa.array(values.ravel()))


def sketch_documents(docs: DataFrame) -> DataFrame:
    """Add the set size, digest and banded registers of ``text``."""

    def sketch(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = texts_as_bytes(batch["text"])
        sets = shingle_sets(texts)
        return [
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array(set_keys(sets), pa.binary()),
            _list_array(_as_bands(sketches(sets))),
        ]

    return with_columns_from_arrow(docs, SKETCH, sketch)


def _membership_filter(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size (8 MB) in which the hash of every id has its bit set."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << _FILTER_BITS))
    words = (
        ids.select(F.floor(place / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {1 << _FILTER_BITS}) % 64 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(1 << (_FILTER_BITS - 6), dtype=np.int64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy()
    return bitmap.view(np.uint64)


def _full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``set_key`` and full ``shingles`` of the documents whose id is in ``ids``, and by chance of a few more.

    Texts are never shuffled: a bitmap of fixed size tells which to read. As
    more ids share its bits, more sets than needed are made, none is missed.
    """
    bitmap = docs.sparkSession.sparkContext.broadcast(_membership_filter(ids))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        bits = bitmap.value
        for batch in (part for whole in batches for part in sliced(whole)):
            at = batch["_place"].to_numpy()
            hit = (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0
            batch = batch.filter(pa.array(hit))
            sets = shingle_sets(texts_as_bytes(batch["text"]))
            keys = set_keys(sets)
            new = []
            for i, key in enumerate(keys):
                if key is not None and key not in seen:
                    seen.add(key)
                    new.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in new], pa.binary()), pa.array([sets[i].tobytes() for i in new], pa.binary())],
                ["set_key", "shingles"],
            )

    placed = docs.select("text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << _FILTER_BITS)).alias("_place"))
    return pin(placed.mapInArrow(tidy(expand), "set_key binary, shingles binary"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with ``100 * intersection >= percent * union`` of their full sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch["_left"].to_pylist(), batch["_right"].to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    kept.append(False)
                    continue
                merged = np.concatenate([x, y])
                merged.sort(kind="stable")
                common = int((merged[1:] == merged[:-1]).sum())
                kept.append(100 * common >= percent * (len(merged) - common))
            yield pa.RecordBatch.from_arrays(
                [column.filter(pa.array(kept, pa.bool_())) for column in (batch["a"], batch["b"])], ["a", "b"]
            )

    left = sets.select(F.col("set_key").alias("a"), F.col("shingles").alias("_left"))
    right = sets.select(F.col("set_key").alias("b"), F.col("shingles").alias("_right"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "_left", "_right")
    return both.mapInArrow(tidy(compare), "a binary, b binary")


def near_duplicates(docs: DataFrame, percent: int = 75, slack: float = 4.0) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept``, a row for each row of ``docs``.

    Documents are linked when ``100 * intersection >= percent * union`` of
    their shingle sets; ``component_id`` is the smallest doc_id reachable. A
    link just at the limit shares a band with probability 0.9999. A candidate
    goes to the full check unless its estimate is below the limit by more than
    ``slack`` standard deviations of 96 registers.

    A null or empty text, or one of white space, is linked with nothing. Rows
    that share a doc_id stay rows of their own. A row without doc_id is its
    own component (null) and kept, unless its text has a group with ids. Other
    columns of ``docs`` are ignored.
    """
    plain = docs.select("doc_id", "text")
    rows = pin(sketch_documents(plain).drop("text"), "sketches")
    classes = pin(
        rows.where(F.col("set_key").isNotNull())
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n_shingles"), F.min("bands").alias("bands")),
        "classes",
    )
    members = classes.where(F.col("first_id").isNotNull()).select(
        F.col("set_key").alias("node"), F.posexplode("bands").alias("band", "value")
    )
    buckets = pin(
        members.groupBy("band", "value")
        .agg(F.min("node").alias("head"), F.count("*").alias("held"))
        .where("held > 1")
        .drop("held"),
        "buckets",
    )
    shared = pin(members.join(buckets, ["band", "value"]), "shared")
    # Each class is first compared with the head it shares the most bands with.
    heads = (
        shared.where(F.col("node") > F.col("head"))
        .groupBy("node", "head")
        .agg(F.count("*").alias("bands"))
        .groupBy("node")
        .agg(F.max(F.struct("bands", "head")).alias("best"))
        .select(F.col("node").alias("a"), F.col("best.head").alias("b"))
    )
    involved = (
        shared.select(F.col("node").alias("set_key"))
        .distinct()
        .join(classes.select("set_key", "first_id"), "set_key")
        .select(F.col("first_id").alias("doc_id"))
    )
    sets = _full_sets(plain, involved)
    first = pin(_confirmed(heads, sets, percent), "links")
    grouped = pin(connected_components(first, "a", "b"), "groups")
    # Then the pairs across components that share a bucket.
    placed = pin(
        shared.join(grouped, "node", "left").select(
            "band", "value", "node", F.coalesce("component", "node").alias("component")
        ),
        "placed",
    )
    parts = placed.select("band", "value", "component").distinct()
    mixed = pin(
        parts.groupBy("band", "value").agg(F.count("*").alias("components")).where("components > 1"), "mixed"
    )
    few = pin(parts.join(mixed.where(F.col("components") <= _CROWD), ["band", "value"]).drop("components"), "few")
    meeting = few.join(
        few.select("band", "value", F.col("component").alias("other")), ["band", "value"]
    ).where(F.col("component") < F.col("other"))
    crossing = (
        meeting.join(placed.withColumnRenamed("node", "a"), ["band", "value", "component"])
        .join(
            placed.select("band", "value", F.col("node").alias("b"), F.col("component").alias("other")),
            ["band", "value", "other"],
        )
        .select("a", "b")
        .distinct()
    )
    tried = heads.select(F.col("a").alias("_a"), F.col("b").alias("_b"))
    crossing = crossing.join(
        tried,
        ((F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))),
        "left_anti",
    )
    likely = pin(_likely(crossing, classes, percent, slack), "likely")
    second = _confirmed(likely, sets, percent)
    crowded = placed.join(mixed.where(F.col("components") > _CROWD), ["band", "value"]).drop("components")
    links = first.unionByName(second).unionByName(_crowded_links(crowded, classes, sets, percent, slack))
    components = pin(connected_components(links, "a", "b"), "components")
    smallest = (
        components.join(classes, F.col("node") == F.col("set_key"))
        .groupBy("component")
        .agg(F.min("first_id").alias("smallest"))
    )
    of_class = pin(
        classes.join(components, F.col("set_key") == F.col("node"), "left")
        .join(smallest, "component", "left")
        .select(F.col("set_key").alias("_key"), F.coalesce("smallest", "first_id").alias("_component")),
        "class-components",
    )
    component = F.coalesce("_component", "doc_id")
    return rows.join(of_class, F.col("set_key") == F.col("_key"), "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )


def _meet(rows: pd.DataFrame, band: int, percent: int, least_equal: float) -> pd.DataFrame:
    """Links between components of one meeting of two blocks, enough to join all that have a link."""
    rows = rows.sort_values("node", ignore_index=True)
    bands = np.stack(rows["bands"].to_numpy())
    registers, sizes = _as_registers(bands), rows["n_shingles"].to_numpy()
    sets = [np.frombuffer(value, np.uint64) for value in rows["shingles"]]
    side, root = rows["side"].to_numpy(), np.unique(rows["component"].to_numpy(), return_inverse=True)[1]
    second = np.flatnonzero(side != 1)
    pairs = []
    for i in np.flatnonzero(side != 2):
        others = second[second > i] if side[i] == 0 else second
        others = others[root[others] != root[i]]
        others = others[100 * np.minimum(sizes[others], sizes[i]) >= percent * np.maximum(sizes[others], sizes[i])]
        equal = (registers[others] == registers[i]).sum(axis=1)
        # A pair belongs to the first band it shares.
        own = (equal >= least_equal) & ~(bands[others, :band] == bands[i, :band]).any(axis=1)
        pairs.append(np.stack([equal[own], np.full(own.sum(), i), others[own]], axis=1))
    pairs = np.concatenate(pairs) if pairs else np.zeros((0, 3), np.int64)
    pairs = pairs[np.argsort(-pairs[:, 0], kind="stable")]
    found = []
    for at in range(0, len(pairs), 4096):
        for _, i, j in pairs[at : at + 4096][root[pairs[at : at + 4096, 1]] != root[pairs[at : at + 4096, 2]]]:
            if root[i] == root[j]:
                continue
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                found.append((i, j))
                root[root == root[j]] = root[i]
    node = rows["node"].to_numpy()
    return pd.DataFrame({"a": [node[i] for i, _ in found], "b": [node[j] for _, j in found]}, dtype=object)


def _crowded_links(crowded: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, slack: float) -> DataFrame:
    """Links (a, b) between components within buckets of any size: blocks of bounded size meet two by two."""
    limit = percent / 100
    least_equal = REGISTERS * limit - slack * np.sqrt(REGISTERS * limit * (1 - limit))
    held = crowded.groupBy("band", "value").agg(F.ceil(F.count("*") / _BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    meetings = crowded.join(held, ["band", "value"]).withColumn("block", block).select(
        "band",
        "value",
        "node",
        "component",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.col("blocks") - 1),
                lambda other: F.struct(
                    F.least("block", other).alias("low"),
                    F.greatest("block", other).alias("high"),
                    F.when(other == F.col("block"), 0).when(other > F.col("block"), 1).otherwise(2).alias("side"),
                ),
            )
        ).alias("m"),
    )

    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _meet(rows, int(key[0]), percent, least_equal)

    detail = classes.select(F.col("set_key").alias("node"), "bands", "n_shingles")
    return (
        meetings.select("band", "value", "node", "component", "m.*")
        .join(detail, "node")
        .join(sets.select(F.col("set_key").alias("node"), "shingles"), "node")
        .groupBy("band", "value", "low", "high")
        .applyInPandas(meet, "a binary, b binary")
    )


def _likely(pairs: DataFrame, classes: DataFrame, percent: int, slack: float) -> DataFrame:
    """The pairs whose registers do not rule out the wanted similarity."""
    limit = percent / 100
    limit -= slack * np.sqrt(limit * (1 - limit) / REGISTERS)

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                _as_registers(batch[name].flatten().to_numpy().reshape(batch.num_rows, BANDS)) for name in ("_x", "_y")
            )
            n, m = (batch[name].to_numpy().astype(float) for name in ("_n", "_m"))
            kept = pa.array(likely_similarity(left, right, n, m) >= limit)
            yield pa.RecordBatch.from_arrays([batch["a"].filter(kept), batch["b"].filter(kept)], ["a", "b"])

    left = classes.select(F.col("set_key").alias("a"), F.col("bands").alias("_x"), F.col("n_shingles").alias("_n"))
    right = classes.select(F.col("set_key").alias("b"), F.col("bands").alias("_y"), F.col("n_shingles").alias("_m"))
    sized = 100 * F.least("_n", "_m") >= percent * F.greatest("_n", "_m")
    both = pairs.join(left, "a").join(right, "b").where(sized).select("a", "b", "_x", "_y", "_n", "_m")
    return both.mapInArrow(tidy(estimate), "a binary, b binary")


def keep_one(docs: DataFrame, **options: object) -> DataFrame:
    """The rows of ``docs`` that are the first of their group: one document of each group stays.

    Of rows with the same doc_id and text one stays. Rows without doc_id
    cannot be told apart and all stay.
    """
    found = near_duplicates(docs, **options)
    by_id = pin(
        found.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("_doc_id"))
        .agg(F.bool_or("kept").alias("_kept"), F.count("*").alias("_rows")),
        "kept",
    )
    dropped = by_id.where("NOT _kept").select("_doc_id")
    rest = docs.join(dropped, F.col("doc_id") == F.col("_doc_id"), "left_anti")
    repeated = by_id.where("_kept AND _rows > 1").select("_doc_id")
    if repeated.isEmpty():
        return rest
    own = F.col("doc_id") == F.col("_doc_id")
    return rest.join(repeated, own, "left_anti").unionByName(
        rest.join(repeated, own, "left_semi").dropDuplicates(["doc_id", "text"])
    )

"""Mixing of sources to target weights.

The words of each source, in order of doc_id, are packed into blocks of a
fixed length. A source gets a number of slots that brings its words to its
target, and each slot is drawn into one of the output shards, so the counts of
a source over the shards are a multinomial draw whose total is fixed. Slot
``j`` of a source maps through the source's own pseudorandom permutation of
its block numbers, ``permute(j mod blocks)``, and is joined with the block of
this number. No block is used again before all blocks of its source have been
used as often.

Everything is arithmetic on integers, so a rerun gives the same mixture. All
columns are DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodlens.llm.common import WORD
from periodlens.operators.ordering import rank_rows, running_totals
from periodlens.session import pin

PRIME = 2_147_483_647
ROUNDS = 10
_CHUNK = 1 << 13


def scramble(a: Column, b: Column | int) -> Column:
    """A hash of two integers in 0 .. PRIME - 1, from products below 2**63 only."""
    b = b if isinstance(b, Column) else F.lit(b)
    first = (F.pmod(a, F.lit(PRIME)) * 48_271 + F.pmod(b, F.lit(PRIME)) * 69_621 + 12_345) % PRIME
    second = (first * 630_360_016 + F.pmod(a, F.lit(65_537)) * 742_938_285) % PRIME
    return (second * 950_706_376 + first) % PRIME


def permutation_rounds(blocks: Column, key: Column) -> Column:
    """The random numbers of a permutation: a point in 0 .. blocks - 1 and a constant for each round."""
    return F.array(
        *[
            F.struct(
                F.pmod(scramble(key, turn) * PRIME + scramble(key, turn + 1000), blocks).alias("point"),
                scramble(key, turn + 2000).alias("constant"),
            )
            for turn in range(ROUNDS)
        ]
    )


def permute(position: Column, blocks: Column, rounds: Column) -> Column:
    """Image of ``position`` under the permutation of 0 .. blocks - 1 that ``rounds`` describes.

    In each round a position may swap with its mirror image about the point,
    as a hash of the larger of the two decides: a bijection for any number of
    blocks.
    """

    def step(x: Column, turn: Column) -> Column:
        other = F.pmod(turn["point"] - x, blocks)
        mixed = (F.greatest(x, other) % PRIME * 48_271 + turn["constant"]) % PRIME * 630_360_016 % PRIME
        return F.when(mixed.bitwiseAND(F.lit(65_536)) == 0, x).otherwise(other)

    return F.aggregate(rounds, position.cast("long"), step)


@dataclass
class Mixture:
    """``documents``: doc_id, source, size, source_key, start (its first word's place in the source).
    ``sources``: source, source_key, source_size, target, blocks, slots.
    ``pieces``: a row for each use of a part of a document, see ``mix``."""

    documents: DataFrame
    sources: DataFrame
    pieces: DataFrame


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Add ``source_key`` (place by code point, null last) and ``target`` to ``source``, ``source_size``.

    Targets are a common level times the weight, at most ``most`` times the
    size; the level is such that they add up to ``share`` of all sizes. In
    order of limit / weight the limited sources come first, so one pass of
    running totals finds the level.
    """
    ranked = rank_rows(sizes, [], [F.col("source").asc_nulls_last()], "source_key")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("source_key") - 1, F.lit(len(weights))) + 1).cast("int")
    )
    limited = (
        ranked.withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * float(most))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
    )
    filled = running_totals(
        limited, [], ["ratio", "source_key"], {"limits": "limit", "weights": "weight", "sizes": "source_size"}
    )
    level = (F.col("sizes_all") * float(share) - (F.col("limits") - F.col("limit"))) / (
        F.col("weights_all") - (F.col("weights") - F.col("weight"))
    )
    filled = filled.withColumn("level", level).withColumn("full", F.col("ratio") <= F.col("level"))
    found = filled.agg(F.min(F.when(~F.col("full"), F.struct("ratio", "source_key", "level")))["level"]).first()[0]
    target = F.col("weight") * F.lit(found if found is not None else 0.0)
    return filled.select(
        "source", "source_key", "source_size", F.when(F.col("full"), F.col("limit")).otherwise(target).alias("target")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = 64,
    shards: int = 256,
) -> Mixture:
    """Mix ``doc_id``, ``source`` and ``text`` of ``docs``.

    ``pieces`` has source_key, block, start, doc_id, size, words (of this
    document in the block), and the slot and shard that use them; slot and
    shard are null where no slot takes the block. A null text has no words;
    documents without words are in ``documents`` only. Repeated rows count
    each. Null is a source of its own, the last. Other columns are ignored. A
    hot source is spread over many tasks: words are added up by sorted slices,
    blocks and slots are dealt by (source, block).
    """
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = pin(docs.select("doc_id", "source", words.alias("size")), "sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    blocks = F.ceil(F.col("source_size") / block_words)
    slots = F.when(
        F.col("source_size") > 0,
        F.least(F.floor(F.col("target") * blocks / F.col("source_size") + 0.5), F.floor(blocks * float(most))),
    ).otherwise(0)
    sources = pin(
        source_targets(sizes, weights, share, most).withColumns(
            {"blocks": blocks.cast("long"), "slots": slots.cast("long")}
        ).withColumn("rounds", permutation_rounds(F.greatest("blocks", F.lit(1)), F.col("source_key"))),
        "sources",
    )
    keys = sources.select(F.col("source").alias("_source"), "source_key")
    placed = (
        running_totals(sized, ["source"], ["doc_id", "size"], {"upto": "size"})
        .join(keys, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("start", (F.col("upto") - F.col("size")).cast("long"))
        .select("doc_id", "source", "source_key", "size", "start")
    )
    documents = pin(placed, "places")
    end = F.col("start") + F.col("size")
    parts = (
        documents.where(F.col("size") > 0)
        .select(
            "source_key",
            "doc_id",
            "size",
            "start",
            F.explode(
                F.sequence(F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words))
            ).alias("block"),
        )
        .withColumn(
            "words",
            F.least(end, (F.col("block") + 1) * block_words) - F.greatest("start", F.col("block") * block_words),
        )
    )
    used = (
        sources.where(F.col("slots") > 0)
        .select("source_key", "blocks", "slots", "rounds", F.explode(F.sequence(F.lit(0), F.col("slots") - 1, F.lit(_CHUNK))).alias("low"))
        # The number is given, or the few short rows would be put into one task before they unfold.
        .repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source_key", "low")
        .select(
            "source_key",
            "blocks",
            "rounds",
            F.explode(F.sequence("low", F.least(F.col("low") + _CHUNK, "slots") - 1)).alias("slot"),
        )
        .select(
            "source_key",
            "slot",
            permute(F.col("slot") % F.col("blocks"), F.col("blocks"), F.col("rounds")).alias("block"),
            F.pmod(scramble(F.col("slot"), F.col("source_key") + 77_777), F.lit(shards)).alias("shard"),
        )
    )
    # Slots unfold from a few rows, so their size is not known before: without the hint they would be broadcast.
    return Mixture(documents, sources, parts.join(used.hint("merge"), ["source_key", "block"], "left"))


def taken_words(mixture: Mixture) -> DataFrame:
    """A row for each document: doc_id, source, size, source_size, target and the words ``taken`` of it, with repeats."""
    taken = F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("words"))), F.lit(0)).alias("taken")
    counted = (
        mixture.pieces.groupBy("source_key", "start", "doc_id", "size")
        .agg(taken)
        .select("source_key", "doc_id", "size", "taken")
        .unionByName(
            mixture.documents.where(F.col("size") == 0).select(
                "source_key", "doc_id", "size", F.lit(0).cast("long").alias("taken")
            )
        )
    )
    return counted.join(mixture.sources.drop("blocks", "slots", "rounds"), "source_key").select(
        "doc_id", "source", "size", "source_size", "target", "taken"
    )


def shard_counts(mixture: Mixture) -> DataFrame:
    """Words of each source in each output shard: shard, source_key, words."""
    return (
        mixture.pieces.where(F.col("slot").isNotNull())
        .groupBy("shard", "source_key")
        .agg(F.sum("words").alias("words"))
    )


def repeat_documents(docs: DataFrame, seed: int = 0, **options: object) -> DataFrame:
    """Whole documents in the numbers the mixture calls for; the columns of ``docs``.

    A document comes ``taken / size`` times, rounded up or down by a hash of
    its id and text, so sources keep their shares and no text is cut.
    Documents without words are left out, as the mixture takes no word of
    them. Rows of one doc_id (null included) share their ratio.
    """
    by_id = (
        taken_words(mix(docs, **options))
        .groupBy("doc_id")
        .agg((F.sum("taken") / F.sum("size")).alias("_ratio"))
        .select(F.col("doc_id").alias("_doc_id"), "_ratio")
        .where("_ratio > 0")
    )
    chance = F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    copies = F.when(F.regexp_like("text", F.lit(WORD)), F.floor(F.col("_ratio") + chance)).otherwise(0).cast("int")
    return (
        docs.join(by_id, F.col("doc_id").eqNullSafe(F.col("_doc_id")))
        .withColumn("_copies", copies)
        .where("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(*docs.columns)
    )


def oracle_sql(block_words: int = 64) -> str:
    """The registered query in SQL for DuckDB."""

    def scrambled(a: str, b: int) -> str:
        first = f"(({a} % {PRIME} * 48271 + {b % PRIME} * 69621 + 12345) % {PRIME})"
        second = f"(({first} * 630360016 + {a} % 65537 * 742938285) % {PRIME})"
        return f"(({second} * 950706376 + {first}) % {PRIME})"

    rounds, last = [], "uses0"
    for i in range(ROUNDS):
        point = f"(({scrambled('source_key', i)} * {PRIME} + {scrambled('source_key', i + 1000)}) % blocks)"
        mixed = (
            f"((greatest(x, other) % {PRIME} * 48271 + {scrambled('source_key', i + 2000)}) % {PRIME} * 630360016 % {PRIME})"
        )
        rounds.append(
            f"mirror{i} AS (SELECT *, ({point} - x + blocks) % blocks AS other FROM {last}), "
            f"uses{i + 1} AS (SELECT source_key, blocks, slot, "
            f"CASE WHEN ({mixed} // 65536) % 2 = 0 THEN x ELSE other END AS x FROM mirror{i})"
        )
        last = f"uses{i + 1}"
    return f"""
WITH sized AS (
  SELECT row_number() OVER () AS row_no, doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents),
weighted AS (
  SELECT source, source_size, source_key, [5.0, 2.0, 1.0][(source_key - 1) % 3 + 1]::DOUBLE AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST)::BIGINT AS source_key FROM sized GROUP BY source)),
levels AS (
  SELECT *, ratio <= level AS full_ FROM (
    SELECT *, 2.0::DOUBLE * source_size / weight AS ratio,
      (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER before_, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before_, 0)) AS level
    FROM weighted
    WINDOW before_ AS (ORDER BY 2.0::DOUBLE * source_size / weight, source_key
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
targets AS (
  SELECT *, CASE WHEN full_ THEN 2.0::DOUBLE * source_size
    ELSE weight * (SELECT level FROM levels WHERE NOT full_ ORDER BY ratio, source_key LIMIT 1) END AS target,
    ceil(source_size / {block_words})::BIGINT AS blocks
  FROM levels),
slotted AS (
  SELECT *, CASE WHEN source_size > 0
    THEN least(floor(target * blocks / source_size + 0.5), 2 * blocks) ELSE 0 END::BIGINT AS slots FROM targets),
placed AS (
  SELECT s.*, t.source_key, t.source_size, t.target,
    (sum(size) OVER (PARTITION BY t.source_key ORDER BY doc_id, size, row_no) - size)::BIGINT AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
pieces AS (
  SELECT row_no, source_key, block,
    least(start + size, (block + 1) * {block_words}) - greatest(start, block * {block_words}) AS words
  FROM (SELECT *, unnest(range(start // {block_words}, (start + size - 1) // {block_words} + 1)) AS block
        FROM placed WHERE size > 0)),
uses0 AS (
  SELECT source_key, blocks, slot, slot % blocks AS x
  FROM (SELECT source_key, blocks, unnest(range(0, slots)) AS slot FROM slotted WHERE slots > 0)),
{", ".join(rounds)},
block_uses AS (SELECT source_key, x AS block, count(*) AS uses FROM {last} GROUP BY ALL),
taken AS (
  SELECT row_no, sum(words * coalesce(uses, 0)) AS taken
  FROM pieces LEFT JOIN block_uses USING (source_key, block) GROUP BY row_no)
SELECT p.doc_id, p.size, p.source_size, p.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM placed p LEFT JOIN taken t USING (row_no)
"""

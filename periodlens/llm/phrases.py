"""Phrase collocations by dynamic itemset counting.

The texts are dealt into shards, which are scanned in turn, again and again. A
phrase is counted from the first shard after both of its subphrases (all but
its last word, all but its first) have reached the threshold in the counts so
far, whatever its length, and until it has seen every shard once. So lengths
overlap: phrases of two words are counted while words still are.

Which phrases have reached the threshold, and before which scan, is kept in a
table of ``2 ** slot_bits`` bytes that is sent to the tasks. A phrase has the slot that
its 64-bit hash names, so a slot can be set by another phrase. Such a phrase is
only counted earlier than it need be: a slot never changes once it is set, so
every phrase is counted for exactly one cycle from the later of its two slots,
each shard once. The table has the same size whatever the input; with more
frequent phrases than slots, counting is less selective and equally right.

Scans count 64-bit hashes. A last scan counts the words themselves of all
phrases whose hash reached the threshold, exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from periodlens.llm.common import chunks_by_size, hash_spans, mix64, texts_as_bytes, tidy
from periodlens.session import drop_scratch, pin, scratch_path

LONGEST = 4
_NEVER = 255
#: Hashes that a task gathers of each size before it counts them.
_HELD = 1 << 20
_BREAK = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
_AHEAD = re.compile(rb"(?:[\x20\x09]*[^\x20\x09.,;:!?\x0A-\x0D]+){0,%d}" % (LONGEST - 1))
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[32, 9]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# --- words of a block of texts --------------------------------------------------------------------------------------


@dataclass
class Words:
    """Words of a block in order. A phrase may begin at the first ``counted`` of them only; the others follow them."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    piece: np.ndarray
    text: np.ndarray
    counted: int

    def begins(self, length: int) -> np.ndarray:
        """Places where a phrase of ``length`` words begins, all in one piece."""
        last = min(self.counted, max(0, len(self.starts) - length + 1))
        return np.flatnonzero(self.piece[:last] == self.piece[length - 1 : last + length - 1])


def _block(data: bytes, bounds: np.ndarray, counted_bytes: int) -> Words:
    lower = _LOWER[np.frombuffer(data, np.uint8)]
    kind = _KIND[lower]
    solid = np.zeros(len(lower) + 2, dtype=np.int8)
    solid[1:-1] = kind == 0
    change = np.diff(solid)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    text = np.searchsorted(bounds, starts, side="right") - 1
    return Words(lower, starts, ends, piece, text, int(np.searchsorted(starts, counted_bytes)))


def blocks(texts: list[bytes], limit: int = 1 << 20) -> Iterator[Words]:
    """The words of all texts, in blocks of about ``limit`` bytes.

    Several texts are joined by a line feed, which ends a piece. A longer text
    is cut before a word; each part then also holds the words after the cut
    that a phrase from before it can reach, so no phrase is lost or seen twice.
    """
    for first, last in chunks_by_size(texts, limit):
        if last - first > 1 or len(texts[first]) <= limit:
            joined = b"\n".join(texts[first:last])
            yield _block(joined, first_bytes(texts, first, last), len(joined))
            continue
        text, at = texts[first], 0
        while at < len(text):
            cut = _BREAK.search(text, min(at + limit, len(text)))
            end = cut.start() if cut else len(text)
            ahead = _AHEAD.match(text, end).end()
            block = _block(text[at:ahead], np.zeros(1, np.int64), end - at)
            block.text += first
            yield block
            at = end


def first_bytes(texts: list[bytes], first: int, last: int) -> np.ndarray:
    """Where each of ``texts[first:last]`` begins when joined by one byte, shifted so that numbers are those of all texts."""
    begins = np.cumsum([0, *(len(t) + 1 for t in texts[first : last - 1])])
    return np.concatenate([np.full(first, -1), begins]) if first else begins


def _languages(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray]:
    encoded = batch["lang"].dictionary_encode()
    return encoded.dictionary.to_pylist(), encoded.indices.to_numpy(zero_copy_only=False)


def _word_hashes(words: Words, salts: np.ndarray) -> np.ndarray:
    """Hashes of the words, each with its language."""
    return mix64(hash_spans(words.data, words.starts, words.ends) ^ salts[words.text])


def _longer(hashes: np.ndarray, words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of phrases of ``length`` words from those one word shorter and from the words."""
    size = max(0, len(words) - length + 1)
    return mix64(hashes[:size] * np.uint64(0x9E3779B97F4A7C15) + words[length - 1 : size + length - 1])


def _salts(names: list[str], codes: np.ndarray) -> np.ndarray:
    named = [name.encode() for name in names]
    data = np.frombuffer(b"".join(named), np.uint8)
    ends = np.cumsum([len(n) for n in named], dtype=np.int64)
    return mix64(hash_spans(data, ends - [len(n) for n in named], ends) + np.uint64(1))[codes]


# --- counting -------------------------------------------------------------------------------------------------------


def _slots(hashes: np.ndarray, slots: int) -> np.ndarray:
    return (hashes & np.uint64(slots - 1)).astype(np.int64)


def _scan(shard: DataFrame, table, step: int, shards: int) -> DataFrame:
    """``hash``, ``size`` and ``n`` of the phrases that are active in this scan; several rows a phrase."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = table.value
        held: dict[int, list[np.ndarray]] = {size: [] for size in range(1, LONGEST + 1)}

        def flush(size: int) -> pa.RecordBatch:
            hashes, n = np.unique(np.concatenate(held[size]), return_counts=True)
            held[size].clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(np.full(len(n), size, np.int8)), pa.array(n.astype(np.int64))],
                ["hash", "size", "n"],
            )

        for batch in batches:
            names, codes = _languages(batch)
            salts = _salts(names, codes)
            for words in blocks(texts_as_bytes(batch["text"])):
                one = shorter = _word_hashes(words, salts)
                for size in range(1, LONGEST + 1):
                    at = words.begins(size)
                    if size == 1:
                        whole = one
                        active = at if step < shards else at[:0]
                    else:
                        whole = _longer(shorter, one, size)
                        before = reached[_slots(shorter, len(reached))]
                        since = np.maximum(before[at], before[at + 1])
                        active = at[(since <= step) & (since.astype(np.int64) + shards > step)]
                    if len(active):
                        held[size].append(whole[active])
                        if sum(map(len, held[size])) >= _HELD:
                            yield flush(size)
                    shorter = whole
        yield from (flush(size) for size in held if held[size])

    return shard.select("lang", "text").mapInArrow(tidy(count), "hash long, size byte, n long")


def _set_slots(counted: DataFrame, bits: int) -> np.ndarray:
    """A bit for each of 2 ** bits slots that a hash in ``counted`` has, low bits first. Built by the tasks: the driver
    gets these bits at most."""
    slot = F.expr(f"(hash & {(1 << bits) - 1}) + 1")
    rows = (
        counted.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    found = np.zeros(max(4096, 1 << (bits - 3)), dtype=np.uint8)
    for row in rows:
        found[(row.bucket - 1) * 4096 : row.bucket * 4096] = np.frombuffer(bytes(row.bits), np.uint8)
    return found[: 1 << (bits - 3)]


def count_phrases(docs: DataFrame, least: int = 30, shards: int = 3, slot_bits: int = 24) -> DataFrame:
    """``lang``, ``size`` (words), ``phrase`` and ``n`` of all phrases of up to four words with ``n >= least``.

    Also, with size 0 and an empty phrase, the number of words of each language.
    ``slot_bits``: size of the table in the driver and in each worker.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "shards")
    docs.select(
        F.coalesce(F.col("lang"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"),
    ).write.partitionBy("shard").parquet(folder)
    dealt = spark.read.schema("lang string, text string, shard int").parquet(folder)

    reached = np.full(1 << slot_bits, _NEVER, dtype=np.uint8)
    state, path, newest, step = None, None, 0, 0
    # A step ends the cycle of what began a cycle ago; nothing is active once a whole cycle has brought nothing new.
    while step < newest + shards:
        table = spark.sparkContext.broadcast(reached)
        rows = _scan(dealt.where(F.col("shard") == step % shards), table, step, shards).withColumn("since", F.lit(step))
        if state is not None:
            # Done and not frequent: counted for a whole cycle, as a phrase is first seen after it became active.
            rows = rows.unionByName(state.where((F.col("n") >= least) | (F.col("since") > step - shards)))
        merged = rows.groupBy("hash", "size").agg(F.sum("n").alias("n"), F.min("since").alias("since"))
        before, path = path, scratch_path(spark, "counts")
        merged.write.parquet(path)
        state = spark.read.schema(merged.schema).parquet(path)
        if before:
            drop_scratch(spark, before)
        table.unpersist()
        now = _set_slots(state.where((F.col("n") >= least) & (F.col("size") < LONGEST)), slot_bits)
        fresh = np.unpackbits(now, bitorder="little").astype(bool) & (reached == _NEVER)
        step += 1
        if fresh.any():
            reached[fresh] = step
            newest = step
    frequent = spark.sparkContext.broadcast(_set_slots(state.where(F.col("n") >= least), slot_bits + 2))
    counted = _count_exactly(dealt, frequent).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    found = pin(counted.where((F.col("n") >= least) | (F.col("size") == 0)), "phrases")
    drop_scratch(spark, path)
    drop_scratch(spark, folder)
    return found


def _count_exactly(dealt: DataFrame, frequent) -> DataFrame:
    """Counts of the words of all phrases whose hash has its bit set in ``frequent``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = frequent.value
        mask = np.uint64(len(bits) * 8 - 1)
        for batch in batches:
            names, codes = _languages(batch)
            salts = _salts(names, codes)
            for words in blocks(texts_as_bytes(batch["text"])):
                one = shorter = _word_hashes(words, salts)
                if not words.counted:
                    continue
                lang = codes[words.text]
                per_lang = np.bincount(lang[: words.counted], minlength=len(names))
                yield _rows(names, np.arange(len(names)), 0, [""] * len(names), per_lang)
                # Each word has a number; a frequent phrase gets one from those of its first words and its last word.
                number, tight = _numbers(words), _Tight(words)
                here = np.zeros(len(one), np.int64)
                for size in range(1, LONGEST + 1):
                    if size > 1:
                        shorter = _longer(shorter, one, size)
                    at = words.begins(size)
                    place = shorter[at] & mask
                    at = at[(bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0]
                    at = at[here[at] >= 0]
                    if not len(at):
                        break
                    keys = (here[at] * (int(number.max()) + 1) + number[at + size - 1]) * len(names) + lang[at]
                    same = pa.array(keys).dictionary_encode().indices.to_numpy().astype(np.int64)
                    n = np.bincount(same)
                    first = np.empty(len(n), np.int64)
                    first[same[::-1]] = np.arange(len(same) - 1, -1, -1)
                    here = np.full(len(one), -1, np.int64)
                    here[at] = same
                    yield _rows(names, keys[first] % len(names), size, tight.phrases(at[first], size), n)

    return dealt.select("lang", "text").mapInArrow(tidy(count), "lang string, size int, phrase string, n long")


class _Tight:
    """The words of a block with one space behind each, to take phrases from."""

    def __init__(self, words: Words):
        self.lengths = words.ends - words.starts + 1
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.data = _gather(np.append(words.data, np.uint8(32)), words.starts, self.lengths)
        self.data[self.begins + self.lengths - 1] = 32

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        """Texts of the phrases of ``size`` words that begin at these words."""
        last = at + size - 1
        lengths = self.begins[last] + self.lengths[last] - 1 - self.begins[at]
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        data = _gather(self.data, self.begins[at], lengths)
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The spans of ``data``, one behind the other."""
    before = np.cumsum(lengths) - lengths
    return data[np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)]


def _rows(names: list[str], lang: np.ndarray, size: int, shown: list[str] | pa.Array, n: np.ndarray) -> pa.RecordBatch:
    langs = pa.DictionaryArray.from_arrays(pa.array(lang.astype(np.int32)), pa.array(names, pa.string())).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [langs, pa.array(np.full(len(n), size, np.int32)), shown if isinstance(shown, pa.Array) else pa.array(shown, pa.string()), pa.array(n.astype(np.int64))],
        ["lang", "size", "phrase", "n"],
    )


def _numbers(words: Words) -> np.ndarray:
    """A number for each word, equal for equal words only."""
    edges = np.empty(2 * len(words.starts) + 1, dtype=np.int32)
    edges[0:-1:2], edges[1::2] = words.starts, words.ends
    edges[-1] = len(words.data)
    parts = pa.BinaryArray.from_buffers(
        pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(words.data))]
    )
    spelled = parts.take(pa.array(np.arange(0, len(edges) - 1, 2)))
    return spelled.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


# --- collocations ---------------------------------------------------------------------------------------------------


def _parts(first: str, size: str) -> str:
    return f"array_join(slice(words, {first}, {size}), ' ')"


def collocations(docs: DataFrame, least: int = 30, cover: int = 80, top: int = 2000, shards: int = 3) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``docs`` needs ``lang`` and ``text``; a null language counts as ``und``, a
    null text as empty. Words are runs without space and tab, A-Z lower-cased;
    ``.,;:!?`` and line ends end a piece, and phrases lie within one. ``a`` is
    the count of the phrase, ``l`` and ``r`` those of its parts where it is cut
    so that ``score = floor(2000000 * a / (l + r))`` is lowest (ties: shortest
    first part). Phrases inside a longer one with at least ``cover`` percent of
    their count are left out. Ties in score and count go by the phrase's bytes.
    Without texts there are no rows.
    """
    counted = count_phrases(docs, least, shards)
    known = counted.where("size > 0").select("lang", "phrase", "n")
    phrases = counted.where("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = phrases.select(
        "*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).selectExpr("lang", "phrase", "a", "k", f"{_parts('1', 'k')} AS first", f"{_parts('k + 1', 'size - k')} AS rest")
    cut = (
        cuts.join(known.withColumnsRenamed({"phrase": "first", "n": "l"}), ["lang", "first"])
        .join(known.withColumnsRenamed({"phrase": "rest", "n": "r"}), ["lang", "rest"])
        .withColumn("score", F.expr("CAST(2000000 AS DECIMAL(38, 0)) * a div (l + r)"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    inner = (
        phrases.where("size > 2")
        .select("*", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("k"))
        .select("*", F.explode(F.sequence(F.lit(1), F.expr("size - k + 1"))).alias("at"))
        .selectExpr("lang", f"{_parts('at', 'k')} AS phrase", "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    kept = cut.join(inner, ["lang", "phrase"], "left").where(
        f"longer IS NULL OR CAST(100 AS DECIMAL(38, 0)) * longer < CAST({cover} AS DECIMAL(38, 0)) * a"
    )
    ranked = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn(
        "rank",
        F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))).cast("long"),
    )
    totals = counted.where("size = 0").select("lang", "n")
    return (
        ranked.where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
    )


def oracle_sql(least: int = 30, cover: int = 80, top: int = 2000) -> str:
    """Counts every phrase of up to four words."""
    grams = " UNION ALL ".join(
        f"""SELECT lang, {size} AS size, array_to_string(ws[i:i + {size - 1}], ' ') AS phrase
        FROM pieces, LATERAL (SELECT unnest(range(1, len(ws) - {size - 2})) AS i)"""
        for size in range(1, LONGEST + 1)
    )
    cuts = " UNION ALL ".join(
        f"""SELECT lang, phrase, a, {k} AS k, array_to_string(ws[1:{k}], ' ') AS head, array_to_string(ws[{k + 1}:], ' ') AS tail
        FROM cand WHERE size > {k}"""
        for k in range(1, LONGEST)
    )
    inner = " UNION ALL ".join(
        f"SELECT lang, array_to_string(ws[{at}:{at + k - 1}], ' ') AS phrase, a FROM cand WHERE size > {k} AND size >= {at + k - 1}"
        for k in range(2, LONGEST)
        for at in range(1, LONGEST - k + 2)
    )
    return rf"""
    WITH cased AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM cased),
    counted AS (SELECT lang, size, phrase, count(*) AS f FROM ({grams}) GROUP BY ALL),
    cand AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counted WHERE size > 1 AND f >= {least}),
    cuts AS ({cuts}),
    scored AS (
        SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, 2000000 * CAST(c.a AS HUGEINT) // (x.f + y.f) AS score
        FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.head JOIN counted y ON y.lang = c.lang AND y.phrase = c.tail),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    covered AS (SELECT lang, phrase, max(a) AS longer FROM ({inner}) GROUP BY ALL),
    kept AS (
        SELECT b.* FROM best b LEFT JOIN covered v ON v.lang = b.lang AND v.phrase = b.phrase
        WHERE v.longer IS NULL OR 100 * CAST(v.longer AS HUGEINT) < {cover} * CAST(b.a AS HUGEINT)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept),
    totals AS (SELECT lang, sum(len(ws)) AS n FROM pieces GROUP BY lang)
    SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
        CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
    FROM ranked JOIN totals USING (lang) WHERE rank <= {top}"""

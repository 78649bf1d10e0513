"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to three bytes deep. A context
predicts the next byte by its counts and keeps the share ``kinds / (total +
kinds)`` for bytes it has not seen; that share goes to the next shorter
context, whose probabilities are divided by what the longer context left over,
so the probabilities of a context add up to one. The statistics are frozen
after the fit, so every (context, byte) has one code length, and the length of
a text is the sum of table entries. The language with the shortest code wins.

Bytes are folded before: A-Z to a-z, digits to ``0``, other ASCII to a space.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodlens.llm.common import chunks_by_size, mix64, texts_as_bytes, tidy, with_columns_from_arrow

DEPTH = 3
_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[48:58] = 48
_FOLD[128:] = np.arange(128, 256)
_FOLD[0] = 0


def _folded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each after ``DEPTH`` zero bytes, and where each one's zeros begin."""
    gap = b"\0" * DEPTH
    data = _FOLD[np.frombuffer(gap + gap.join(texts) if texts else b"", dtype=np.uint8)]
    return data, np.cumsum([0, *(len(text) + DEPTH for text in texts)])


def _four_grams(texts: list[bytes]) -> np.ndarray:
    data, bounds = _folded(texts)
    wide = data.astype(np.uint32)
    grams = wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:]
    own = np.ones(len(grams), dtype=bool)
    for back in range(DEPTH):  # grams that end in the next text's zeros
        at = bounds[1:-1] - DEPTH + back
        own[at[at >= 0]] = False
    return grams[own]


@dataclass
class LanguageModel:
    """Frozen statistics: a trie of the grams seen in any language, with code lengths in bits for each language.

    ``children[d][node * width + symbol]`` is the node of a gram one longer, 0
    if unknown; ``bits[d][node]`` the code length of a gram's last byte after
    the bytes before it; ``leave[d][node]`` the cost of leaving this context.
    """

    languages: list[str]
    symbols: np.ndarray
    width: int
    children: list[np.ndarray]
    bits: list[np.ndarray]
    leave: list[np.ndarray]

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language; texts of any length, in pieces of bounded memory."""
        out = np.zeros((len(texts), len(self.languages)))
        for first, last in chunks_by_size(texts, 1 << 20):
            if last - first == 1 and len(texts[first]) > 1 << 21:
                text = texts[first]
                for at in range(0, len(text), 1 << 20):
                    before = (b"\0" * DEPTH + text[:at])[-DEPTH:] if at < DEPTH else text[at - DEPTH : at]
                    piece = _FOLD[np.frombuffer(before + text[at : at + (1 << 20)], dtype=np.uint8)]
                    out[first] += self._bits_of(piece).sum(axis=0, dtype=np.float64)
                continue
            data, bounds = _folded(texts[first:last])
            if len(data) <= DEPTH:
                continue
            each = self._bits_of(data)
            # Position p of each is byte p + DEPTH: a text's bytes are followed by the zeros of the next one.
            for i, text in enumerate(texts[first:last]):
                out[first + i] = each[bounds[i] : bounds[i] + len(text)].sum(axis=0, dtype=np.float64)
        return out

    def _bits_of(self, data: np.ndarray) -> np.ndarray:
        symbols, width = self.symbols[data].astype(np.int32), self.width
        found = [self.children[0][symbols]]
        for depth in range(1, DEPTH + 1):
            found.append(self.children[depth][found[-1][:-1] * width + symbols[depth:]])
        top = found[DEPTH]
        total = self.bits[DEPTH][top]
        missing = np.flatnonzero(top == 0)
        if len(missing):
            rest = np.zeros((len(missing), total.shape[1]), dtype=np.float32)
            open_, at = np.arange(len(missing)), missing
            for depth in range(DEPTH - 1, -1, -1):
                # The context of depth + 1 bytes ends one position before the byte itself.
                rest[open_] += self.leave[depth][found[depth][at + DEPTH - 1 - depth]]
                node = found[depth][at + DEPTH - depth]
                known = node > 0 if depth else np.ones(len(node), dtype=bool)
                rest[open_[known]] += self.bits[depth][node[known]]
                open_, at = open_[~known], at[~known]
            total[missing] = rest
        return total


def _grouped(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kinds, place = np.unique(keys, return_inverse=True)
    sums = np.zeros((len(kinds), counts.shape[1]))
    np.add.at(sums, place, counts)
    return kinds, sums


def build_model(
    languages: list[str], grams: np.ndarray, places: np.ndarray, counts: np.ndarray, max_contexts: int = 65_536
) -> LanguageModel:
    """Freeze four-gram counts: ``grams`` as integers, ``places`` in ``languages``, ``counts``."""
    kinds, row = np.unique(grams, return_inverse=True)
    table = np.zeros((len(kinds), len(languages)))
    np.add.at(table, (row, places), counts)
    by_length = [(kinds.astype(np.int64), table)]
    for length in (3, 2, 1):
        keys, sums = by_length[0]
        by_length.insert(0, _grouped(keys & ((1 << 8 * length) - 1), sums))
    # The most frequent three-byte contexts keep their four-grams; each language counts by its own shares.
    contexts, total = _grouped(by_length[3][0] >> 8, by_length[3][1])
    if len(contexts) > max_contexts:
        share = (total / np.maximum(1, total.sum(axis=0))).max(axis=1)
        best = np.sort(contexts[np.argsort(-share, kind="stable")[:max_contexts]])
        kept = np.isin(by_length[3][0] >> 8, best)
        by_length[3] = (by_length[3][0][kept], by_length[3][1][kept])
    used = np.unique(by_length[0][0]).astype(np.int64)
    symbols = np.zeros(256, dtype=np.uint8)
    symbols[used] = np.arange(1, len(used) + 1)
    width = len(used) + 1
    children, bits, leave, nodes = [], [], [], []
    for depth, (keys, sums) in enumerate(by_length):
        last = symbols[keys & 255].astype(np.int64)
        if depth == 0:
            child = np.zeros(width, dtype=np.int32)
            child[last] = np.arange(1, len(keys) + 1)
            shorter = np.full((len(keys), len(languages)), 1 / 256)
            where = np.zeros(len(keys), dtype=np.int64)
            size = 1
        else:
            where = np.searchsorted(nodes[-1], keys >> 8) + 1
            present = np.isin(keys >> 8, nodes[-1])
            keys, sums, last, where = keys[present], sums[present], last[present], where[present]
            size = len(nodes[-1]) + 1
            child = np.zeros(size * width, dtype=np.int32)
            child[where * width + last] = np.arange(1, len(keys) + 1)
            suffix = np.searchsorted(nodes[-1], keys & ((1 << 8 * depth) - 1)) + 1
            shorter = 2.0 ** -bits[-1][suffix]
        held = np.zeros((size, len(languages)))
        kinds_in = np.zeros((size, len(languages)))
        covered = np.zeros((size, len(languages)))
        np.add.at(held, where, sums)
        np.add.at(kinds_in, where, sums > 0)
        np.add.at(covered, where, np.where(sums > 0, shorter, 0))
        escape = kinds_in / np.maximum(held + kinds_in, 1)
        back = np.where(held > 0, escape / np.maximum(1 - covered, 1e-12), 1.0)
        chance = np.where(sums > 0, sums / np.maximum(held + kinds_in, 1)[where], back[where] * shorter)
        cost = np.zeros((len(keys) + 1, len(languages)))
        cost[1:] = -np.log2(chance)
        if depth == 0:
            cost[0] = -np.log2(back[0] / 256)
        else:
            leave.append(-np.log2(back).astype(np.float32))
        children.append(child)
        bits.append(cost.astype(np.float32))
        nodes.append(keys)
    return LanguageModel(languages, symbols, width, children, bits, leave)


def fit(labelled: DataFrame, sample_bytes: int = 4_000_000, max_contexts: int = 65_536, block_bytes: int = 8192) -> LanguageModel:
    """Learn from ``text`` and ``lang`` of the given rows; rows without either are left out.

    The fit reads blocks of ``block_bytes``, chosen by a hash of their text and
    place, of about ``sample_bytes`` for each language, and the first block of
    the text with the lowest hash, so every language with a text is learned.
    It keeps ``max_contexts`` contexts of three bytes, those with the largest
    share of a language. Neither the counts nor the model grow with the
    corpus. All counts of the sample are used, also those of bytes seen once.
    ``lang`` has one model for each value, so its values should be languages.
    """
    place = F.xxhash64("text")
    usable = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang", place.alias("place"))
    sizes = (
        usable.where("text <> ''").groupBy("lang").agg(F.sum(F.octet_length("text")).alias("held"), F.min("place").alias("lowest")).collect()
    )
    languages = sorted(row.lang for row in sizes)
    if not languages:
        return build_model([], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    shares = {row.lang: min(1.0, sample_bytes / row.held) for row in sizes}
    lowest = {row.lang: row.lowest for row in sizes}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs, places = texts_as_bytes(batch["text"]), batch["lang"].to_pylist(), batch["place"].to_pylist()
            chosen: dict[str, list[bytes]] = {}
            for text, lang, where in zip(texts, langs, places, strict=True):
                if not text:
                    continue
                blocks = np.arange(-(-len(text) // block_bytes), dtype=np.uint64)
                picked = mix64(blocks + np.uint64(where & 0xFFFFFFFFFFFFFFFF)) <= shares[lang] * float(2**64 - 1)
                picked[0] |= where == lowest[lang]
                for at in np.flatnonzero(picked).tolist():
                    chosen.setdefault(lang, []).append(text[at * block_bytes : (at + 1) * block_bytes])
            for lang, own in sorted(chosen.items()):
                for first, last in chunks_by_size(own, 1 << 22):
                    grams, n = np.unique(_four_grams(own[first:last]), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(n)],
                        ["lang", "gram", "n"],
                    )

    counted = (
        usable.mapInArrow(tidy(count), "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    order = {lang: i for i, lang in enumerate(languages)}
    places = np.array([order[lang] for lang in counted["lang"].to_pylist()], dtype=np.int64)
    return build_model(languages, counted["gram"].to_numpy(), places, counted["n"].to_numpy(), max_contexts)


ADDED = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("bits_per_byte", T.DoubleType()),
    ]
)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``bits_per_byte`` to every row of ``docs``, from ``text`` alone.

    ``score`` is the posterior of the language under equal priors. A text that
    is null or has no letter gets ``und``, score 0 and null bits; so does every
    text if the model knows no language. Equal code lengths go to the first
    language by name. Input columns with the added names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    letters = "_has_letter"

    def score(batch: pa.RecordBatch) -> list[pa.Array]:
        known = shared.value
        texts = texts_as_bytes(batch["text"])
        usable = np.array([bool(x) for x in batch[letters].to_pylist()], dtype=bool)
        if not known.languages:
            usable[:] = False
        chosen = [text if ok else b"" for text, ok in zip(texts, usable, strict=True)]
        bits = known.code_lengths(chosen)
        names: list[str] = ["und"] * len(texts)
        scores, rates = np.zeros(len(texts)), np.full(len(texts), np.nan)
        if known.languages:
            best = bits.argmin(axis=1)
            gap = np.minimum(bits - bits.min(axis=1, keepdims=True), 1000)
            scores = np.where(usable, 1 / (2.0**-gap).sum(axis=1), 0)
            rates = bits.min(axis=1) / np.maximum(1, [len(text) for text in chosen])
            names = [known.languages[b] if ok else "und" for b, ok in zip(best, usable, strict=True)]
        return [pa.array(names, pa.string()), pa.array(scores), pa.array(rates, mask=~usable)]

    marked = docs.withColumn(letters, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return with_columns_from_arrow(marked, ADDED, score).drop(letters)


def accepted(min_score: float = 0.5, max_bits_per_byte: float = 8.0) -> Column:
    """Whether an identified text is kept: a language is known, likelier than the others together, and its model
    codes the text in fewer bits than the raw bytes have."""
    return (
        (F.col("lang_pred") != "und")
        & (F.col("score") >= min_score)
        & (F.col("bits_per_byte") < max_bits_per_byte)
    )

"""Scoring by a log-bilinear neural language model, beside an add-one unigram model.

A text is its words, A-Z lower-cased, and one end. The neural model predicts a
symbol from the two before it: ``R[s1] @ C1 + R[s2] @ C2`` is the predicted
vector, and a symbol's score is its product with the symbol's output vector,
plus a bias. Symbols are the most frequent words and, for all others, classes
of word endings. A word of a class has the probability of the class times its
add-one share of the class, one share being left for words never seen, so the
probabilities of all words add up to one. The word counts are those of the
whole training corpus.

Training is noise-contrastive estimation in numpy: every partition improves
the shared parameters on its own texts, and their mean by number of tokens
goes into the next round. Scoring normalises exactly, by matrix products over
the distinct contexts of a block of texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodlens.llm.common import hash_words_and_endings, mix64, sliced, texts_as_bytes
from periodlens.session import pin

HEAD, CLASSES, WIDTH = 256, 256, 32
SYMBOLS = HEAD + CLASSES
START = SYMBOLS
END = np.uint64(0x2545F4914F6CDD1D)  # stands for the end of a text
_END_CLASS = 0
_FREQUENT = 1 << 20
_HELD = 1 << 19
_BATCH, _NOISE = 4096, 64


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, class and text number of all tokens; an end follows each text's words."""
    words, bounds, endings = hash_words_and_endings(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    total = len(words) + len(texts)
    at_word, at_end = np.arange(len(words)) + owner, bounds[1:] + np.arange(len(texts))
    hashes, classes, owners = np.empty(total, np.uint64), np.empty(total, np.int64), np.empty(total, np.int64)
    hashes[at_word], hashes[at_end] = words, END
    classes[at_word] = (mix64(endings.astype(np.uint64) + np.uint64(1)) % np.uint64(CLASSES)).astype(np.int64)
    classes[at_end] = _END_CLASS
    owners[at_word], owners[at_end] = owner, np.arange(len(texts))
    return hashes, classes, owners


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` (hash), ``class`` and ``n``, its number in all texts of ``docs``; the end of a text counts as a word.

    A partition adds up its own words, a bounded number at a time, before they are shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            hashes, classes, n = (np.concatenate(column) for column in zip(*held, strict=True))
            kinds, first, place = np.unique(hashes, return_index=True, return_inverse=True)
            return kinds, classes[first], np.bincount(place, weights=n).astype(np.int64)

        def rows(columns: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
            kinds, classes, n = columns
            return pa.RecordBatch.from_arrays(
                [pa.array(kinds.view(np.int64)), pa.array(classes.astype(np.int32)), pa.array(n)], ["word", "class", "n"]
            )

        for batch in (part for whole in batches for part in sliced(whole)):
            hashes, classes, _ = _tokens(texts_as_bytes(batch["text"]))
            kinds, first, n = np.unique(hashes, return_index=True, return_counts=True)
            held.append((kinds, classes[first], n))
            if sum(len(part[0]) for part in held) > 2 * _HELD:
                held[:] = [merged()]
                if len(held[0][0]) > _HELD:
                    yield rows(held.pop())
        if held:
            yield rows(merged())

    counted = docs.select("text").mapInArrow(count, "word long, class int, n long")
    return counted.groupBy("word").agg(F.min("class").alias("class"), F.sum("n").alias("n"))


@dataclass
class Parameters:
    vectors: np.ndarray
    first: np.ndarray
    second: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.vectors, self.first, self.second, self.output, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()]).astype(np.float32)

    @staticmethod
    def unflatten(values: np.ndarray) -> Parameters:
        shapes = [(SYMBOLS + 1, WIDTH), (WIDTH, WIDTH), (WIDTH, WIDTH), (SYMBOLS, WIDTH), (SYMBOLS,)]
        parts, at = [], 0
        for shape in shapes:
            size = math.prod(shape)
            parts.append(np.array(values[at : at + size], dtype=np.float32).reshape(shape))
            at += size
        return Parameters(*parts)


@dataclass
class Vocabulary:
    """What scoring needs of the counts. ``hashes`` (sorted), ``counts``, ``symbols``: the frequent words, at most
    about a million. ``class_mass``: tokens + kinds + 1 of each class."""

    hashes: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    class_mass: np.ndarray
    tokens: int
    kinds: int
    unigram: np.ndarray

    def look_up(self, hashes: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbol, count (0 if not among the frequent) and whether it is frequent, of each token."""
        if not len(self.hashes):
            return HEAD + classes, np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        found = self.hashes[at] == hashes
        return np.where(found, self.symbols[at], HEAD + classes), np.where(found, self.counts[at], 0), found


def build_vocabulary(counted: DataFrame, frequent: int = _FREQUENT) -> tuple[Vocabulary, int]:
    """The vocabulary, and the count from which a word is in its table of frequent words.

    The table has a fixed greatest size; rarer words are joined by the caller.
    """
    steps = counted.groupBy(F.floor(F.log2("n") * 16).alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("n"))
    least, held = 0, 0
    for row in steps.orderBy(F.desc("step")).collect():
        held += row.words
        if held > frequent:
            break
        least = row.n
    end = int(END.view(np.int64))
    totals = counted.agg(F.sum("n"), F.count("*")).first()
    head = [
        row.word
        for row in counted.where(F.col("word") != end).orderBy(F.desc("n"), "word").limit(HEAD - 1).collect()
    ]
    table = counted.where((F.col("n") >= least) if least else F.lit(False)).toArrow()
    order = np.argsort(table["word"].to_numpy().view(np.uint64))
    hashes = table["word"].to_numpy().view(np.uint64)[order]
    counts, symbols = table["n"].to_numpy()[order], HEAD + table["class"].to_numpy()[order].astype(np.int64)
    numbers = {word: i + 1 for i, word in enumerate(head)} | {end: 0}
    for word, symbol in numbers.items():
        place = np.searchsorted(hashes, np.int64(word).view(np.uint64))
        if place < len(hashes) and hashes[place] == np.int64(word).view(np.uint64):
            symbols[place] = symbol
    unigram, kinds = np.zeros(SYMBOLS), np.zeros(CLASSES)
    by_class = counted.where(~F.col("word").isin([*head, end])).groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("k"))
    for row in by_class.collect():
        unigram[HEAD + row["class"]], kinds[row["class"]] = row.n, row.k
    in_head = symbols < HEAD
    np.add.at(unigram, symbols[in_head], counts[in_head])
    mass = unigram[HEAD:] + kinds + 1
    return Vocabulary(hashes, counts, symbols, mass, int(totals[0] or 0), int(totals[1]), unigram), least


def _contexts(symbols: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    before, earlier = np.full(len(symbols), START), np.full(len(symbols), START)
    same = owners[1:] == owners[:-1]
    before[1:][same] = symbols[:-1][same]
    same = owners[2:] == owners[:-2]
    earlier[2:][same] = symbols[:-2][same]
    return before, earlier


def starting_parameters(unigram: np.ndarray) -> Parameters:
    """Small random vectors; the biases make it the unigram model."""
    random = np.random.default_rng(10)
    draw = lambda *shape: random.normal(0, 0.1, shape).astype(np.float32)
    chance = (unigram + 1) / (unigram + 1).sum()
    return Parameters(
        draw(SYMBOLS + 1, WIDTH),
        np.eye(WIDTH, dtype=np.float32),
        np.eye(WIDTH, dtype=np.float32) * np.float32(0.5),
        draw(SYMBOLS, WIDTH),
        np.log(chance).astype(np.float32),
    )


def _sum_rows(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``rows``, in order, and the sum of the ``values`` of each."""
    rows = rows.astype(np.uint16 if SYMBOLS < 1 << 16 else np.int64)  # short integers are sorted by radix
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    return ordered[starts], np.add.reduceat(values.take(order, axis=0), starts, axis=0)


class Trainer:
    """Noise-contrastive estimation with Adagrad; a batch shares its noise symbols."""

    def __init__(self, parameters: Parameters, unigram: np.ndarray, rate: float, seed: int):
        self.p, self.rate, self.random = parameters, rate, np.random.default_rng(seed)
        noise = (unigram + 1) / (unigram + 1).sum()
        self.steps, self.log_noise = np.cumsum(noise), np.log(noise * _NOISE).astype(np.float32)
        self.squares = [np.full(a.shape, 1e-2, np.float32) for a in parameters.arrays()]
        self.tokens = 0

    def learn(self, before: np.ndarray, earlier: np.ndarray, target: np.ndarray) -> None:
        order = self.random.permutation(len(target))
        for at in range(0, len(order), _BATCH):
            rows = order[at : at + _BATCH]
            self._step(before[rows], earlier[rows], target[rows])
        self.tokens += len(target)

    def _step(self, before: np.ndarray, earlier: np.ndarray, target: np.ndarray) -> None:
        p = self.p
        noise = np.minimum(np.searchsorted(self.steps, self.random.random(_NOISE)), SYMBOLS - 1)
        # Contexts are few: their vectors are multiplied once each, gradients added up for each before products.
        predicted = (p.vectors @ p.first).take(before, axis=0)
        predicted += (p.vectors @ p.second).take(earlier, axis=0)
        outputs, noise_outputs = p.output.take(target, axis=0), p.output[noise]
        own = np.einsum("ij,ij->i", predicted, outputs) + (p.bias - self.log_noise)[target]
        g_own = 1 / (1 + np.exp(-np.clip(own, -30, 30))) - 1
        g_other = predicted @ noise_outputs.T
        g_other += p.bias[noise] - self.log_noise[noise]
        np.clip(g_other, -30, 30, out=g_other)
        np.negative(g_other, out=g_other)
        np.exp(g_other, out=g_other)
        g_other += 1
        np.reciprocal(g_other, out=g_other)
        outputs *= g_own[:, None]
        outputs += g_other @ noise_outputs
        gradients = [np.zeros_like(a) for a in p.arrays()]
        for place, rows, matrix in ((1, before, p.first), (2, earlier, p.second)):
            kinds, sums = _sum_rows(rows, outputs)
            gradients[0][kinds] += sums @ matrix.T
            gradients[place] += p.vectors[kinds].T @ sums
        np.add.at(gradients[3], noise, g_other.T @ predicted)
        predicted *= g_own[:, None]
        kinds, sums = _sum_rows(target, predicted)
        gradients[3][kinds] += sums
        gradients[4] += np.bincount(target, weights=g_own, minlength=SYMBOLS).astype(np.float32)
        gradients[4] += np.bincount(noise, weights=g_other.sum(axis=0), minlength=SYMBOLS).astype(np.float32)
        for values, squares, gradient in zip(p.arrays(), self.squares, gradients, strict=True):
            squares += gradient**2 * np.float32(1e-3)
            values -= np.float32(self.rate * 0.03) * gradient / np.sqrt(squares)


def fit(docs: DataFrame, vocabulary: Vocabulary, rounds: int = 2, rate: float = 0.08) -> Parameters:
    """Train on all texts of ``docs`` in every round.

    In each round every partition trains a copy; copies are averaged in tasks
    first, the driver adds up at most the square root of their number.
    """
    spark = docs.sparkSession
    texts = docs.select("text")
    parameters = starting_parameters(vocabulary.unigram)
    known = spark.sparkContext.broadcast(vocabulary)
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(parameters.flat())

        def train(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(Parameters.unflatten(shared.value), known.value.unigram, rate / (1 + turn), turn)
            for batch in (part for whole in batches for part in sliced(whole)):
                hashes, classes, owners = _tokens(texts_as_bytes(batch["text"]))
                symbols, _, _ = known.value.look_up(hashes, classes)
                trainer.learn(*_contexts(symbols, owners), symbols)
            if trainer.tokens:
                yield _weighted(trainer.p.flat().astype(np.float64) * trainer.tokens, trainer.tokens)

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, weight = None, 0.0
            for batch in batches:
                for values, n in zip(batch["total"].to_pylist(), batch["weight"].to_pylist(), strict=True):
                    values = np.frombuffer(values)
                    total, weight = (values if total is None else total + values), weight + n
            if total is not None:
                yield _weighted(total, weight)

        kind = "total binary, weight double"
        copies = texts.mapInArrow(train, kind)
        groups = max(1, math.isqrt(copies.rdd.getNumPartitions()))
        sums = copies.repartition(groups).mapInArrow(add_up, kind).collect()
        weight = sum(row.weight for row in sums)
        if not weight:
            break
        parameters = Parameters.unflatten(sum(np.frombuffer(row.total) for row in sums) / weight)
    return parameters


def _weighted(total: np.ndarray, weight: float) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([total.tobytes()], pa.binary()), pa.array([float(weight)])], ["total", "weight"]
    )


def log_probabilities(
    parameters: Parameters, before: np.ndarray, earlier: np.ndarray, target: np.ndarray, block: int = 4096
) -> np.ndarray:
    """Natural logarithm of the normalised probability of each target symbol."""
    near, far = parameters.vectors @ parameters.first, parameters.vectors @ parameters.second
    pairs, place = np.unique(before * (SYMBOLS + 1) + earlier, return_inverse=True)
    norms = np.empty(len(pairs), np.float32)
    for at in range(0, len(pairs), block):
        some = pairs[at : at + block]
        scores = (near[some // (SYMBOLS + 1)] + far[some % (SYMBOLS + 1)]) @ parameters.output.T + parameters.bias
        top = scores.max(axis=1)
        norms[at : at + block] = np.log(np.exp(scores - top[:, None]).sum(axis=1)) + top
    own = np.empty(len(target), np.float32)
    for at in range(0, len(target), 1 << 15):
        part = slice(at, at + (1 << 15))
        predicted = near[before[part]] + far[earlier[part]]
        own[part] = np.einsum("ij,ij->i", predicted, parameters.output[target[part]]) + parameters.bias[target[part]]
    return (own - norms[place]).astype(np.float64)


def score(docs: DataFrame, counted: DataFrame, vocabulary: Vocabulary, least: int, parameters: Parameters) -> DataFrame:
    """Add ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10) to rows of ``docs``.

    A null text counts as empty: one end. Frequent words are looked up in the
    task; each rare word is joined with its count by shuffle. Columns of
    ``docs`` other than ``text`` are kept; those with an added name are replaced.
    """
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rest = docs.drop("_row", "_rare", "_rare_sum", "_rare_known", *added)
    kept = [name for name in rest.columns if name != "text"]
    known = docs.sparkSession.sparkContext.broadcast((vocabulary, parameters))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = known.value
        all_mass = math.log10(words.tokens + words.kinds + 1)
        class_mass = np.log10(words.class_mass)
        for batch in (part for whole in batches for part in sliced(whole)):
            texts = texts_as_bytes(batch["text"])
            n = len(texts)
            hashes, classes, owners = _tokens(texts)
            base, own, seen, sizes = np.zeros(n), np.zeros(n), np.zeros(n), np.bincount(owners, minlength=n)
            rare: list[np.ndarray] = []
            # Blocks overlap by the two symbols of context.
            for at in range(0, len(hashes), 1 << 19):
                low, high = max(0, at - 2), min(len(hashes), at + (1 << 19))
                part, skip = owners[low:high], at - low
                symbols, counts, found = words.look_up(hashes[low:high], classes[low:high])
                before, earlier = _contexts(symbols, part)
                before, earlier, symbols, counts, found, part = (
                    x[skip:] for x in (before, earlier, symbols, counts, found, part)
                )
                parts = log_probabilities(model, before, earlier, symbols) / math.log(10)
                logs = np.log10(counts + 1.0)
                in_class = symbols >= HEAD
                parts[in_class] += logs[in_class] - class_mass[symbols[in_class] - HEAD]
                base += np.bincount(part, weights=logs - all_mass, minlength=n)
                own += np.bincount(part, weights=parts, minlength=n)
                seen += np.bincount(part, weights=counts > 0, minlength=n)
                rare.append(np.flatnonzero(~found) + at)
            rare_at = np.concatenate([np.zeros(0, np.int64), *rare])
            offsets = np.searchsorted(owners[rare_at], np.arange(n + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, pa.array(hashes[rare_at].view(np.int64)))
            arrays = [pa.array(sizes), pa.array(seen.astype(np.int64)), pa.array(base), pa.array(own), lists]
            yield pa.RecordBatch.from_arrays(
                [*(batch[name] for name in kept), *arrays], [*kept, "n_tokens", "n_known", "base_score", "score", "_rare"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields if f.name != "text")
    schema = ", ".join(filter(None, [fields, "n_tokens long, n_known long, base_score double, score double, _rare array<long>"]))
    partial = pin(rest.mapInArrow(apply, schema).withColumn("_row", F.monotonically_increasing_id()), "scored")
    rare_counts = counted.where(F.col("n") < least) if least else counted
    sums = (
        partial.select("_row", F.explode("_rare").alias("word"))
        .join(rare_counts.select("word", "n"), "word")
        .groupBy(F.col("_row").alias("_of"))
        .agg(F.sum(F.log10(F.col("n") + 1)).alias("_rare_sum"), F.count("*").alias("_rare_known"))
    )
    more = F.coalesce("_rare_sum", F.lit(0.0))
    return partial.join(sums, F.col("_row") == F.col("_of"), "left").select(
        *kept,
        "n_tokens",
        (F.col("n_known") + F.coalesce("_rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )


def score_texts(docs: DataFrame, training: DataFrame) -> DataFrame:
    """Learn from ``training`` and score ``docs``."""
    counted = pin(count_words(training), "word-counts")
    vocabulary, least = build_vocabulary(counted)
    return score(docs, counted, vocabulary, least, fit(training, vocabulary))

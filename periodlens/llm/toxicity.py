"""Toxicity by a weighted finite-state pattern grammar.

A text is a sequence of words and clause ends. A lexical transducer rewrites
each word to a symbol: insult, threat, target (whom it is said to), negation,
reported speech, or other. Small transducers follow these symbols: one keeps
whether a target stands in the clause, one for how many more words a negation
reaches, one whether the clause reports what somebody said. Their composition
is one machine, which writes an event for each insult or threat with the
context it stands in. A text's weight adds up, for each event, a weight if any
clause matches and another one times the logarithm of one more than the number
of clauses that match.

The lists below are a start in four languages. More insults, as words or as
stems, are learned from labelled rows, and so are the weights.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodlens.llm.common import tidy, with_columns_from_arrow
from periodlens.session import pin

OTHER, END, INSULT, THREAT, TARGET, NEGATION, REPORT = range(7)

# Fixed word lists.
STARTING_WORDS = {
    INSULT: "idiot idiots moron morons stupid loser losers scum trash pathetic worthless disgusting clown dumb imbecile "
    "vermin freak ugly fool filth idioten dummkopf abschaum versager trottel dreckskerl imbécile crétin connard "
    "ordure estúpido imbécil basura escoria inútil",
    THREAT: "kill murder destroy hurt stab shoot strangle töten umbringen vernichten tuer détruire matar destruir",
    TARGET: "you your yours u they them du dich dir euch sie tu te toi vous ti usted ustedes vosotros",
    NEGATION: "not no never isn aren don nor without nicht kein keine nie ne pas jamais nunca ni tampoco",
    REPORT: "said says say called calls wrote reported quoted claimed sagte nannte schrieb dit appelé écrit dijo llamó escribió",
}

_TOKENS = re.compile(r"[^\W\d_]+|[.!?;\n]")
_ENDS = frozenset(".!?;\n")
STEM_LENGTHS = (4, 5, 6)
REACH = 3
EVENTS = 16


def _target(state: int, symbol: int) -> int:
    return 0 if symbol == END else 1 if symbol == TARGET else state


def _negation(state: int, symbol: int) -> int:
    return 0 if symbol == END else REACH if symbol == NEGATION else max(0, state - 1)


def _report(state: int, symbol: int) -> int:
    return 0 if symbol == END else 1 if symbol == REPORT else state


def compose() -> tuple[list[list[int]], list[list[int]]]:
    """Next state and event (-1: none) by state and symbol, for the product of the transducers."""
    states = list(itertools.product(range(2), range(REACH + 1), range(2)))
    number = {state: i for i, state in enumerate(states)}
    moves, events = [], []
    for target, negation, report in states:
        moves.append([])
        events.append([])
        for symbol in range(7):
            after = _target(target, symbol), _negation(negation, symbol), _report(report, symbol)
            moves[-1].append(number[after])
            kind = {INSULT: 0, THREAT: 1}.get(symbol)
            events[-1].append(-1 if kind is None else kind * 8 + target * 4 + (negation > 0) * 2 + report)
    return moves, events


@dataclass
class Grammar:
    """Symbols of whole words and of stems, and the weight of each event."""

    words: dict[str, int]
    stems: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.repeat([3.0, 0.5], EVENTS))
    bias: float = -2.0


class _Lexicon(dict):
    """Symbol of a word; remembers what it has looked up, up to a bound."""

    def __init__(self, grammar: Grammar):
        super().__init__()
        self.grammar = grammar

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        symbol = END if word in _ENDS else self.grammar.words.get(word, OTHER)
        if symbol == OTHER:
            for length in STEM_LENGTHS:
                if len(word) >= length and (found := self.grammar.stems.get(word[:length])):
                    symbol = found
        self[word] = symbol
        return symbol


_MOVES, _EVENTS = compose()
_BLOCK = 200_000


def matched_clauses(text: str, lexicon: _Lexicon) -> np.ndarray:
    """For each event, how many clauses of ``text`` hold it. Runs through the text in blocks of words."""
    counts, state = np.zeros(EVENTS), 0
    stream = (match.group() for match in _TOKENS.finditer(text)) if len(text) > 2_000_000 else None
    blocks = (
        [_TOKENS.findall(text)] if stream is None else iter(lambda: list(itertools.islice(stream, _BLOCK)), [])
    )
    open_events: set[int] = set()
    for block in blocks:
        symbols = list(map(lexicon.__getitem__, block))
        if INSULT not in symbols and THREAT not in symbols and stream is None:
            return counts
        for symbol in symbols:
            event = _EVENTS[state][symbol]
            state = _MOVES[state][symbol]
            if event >= 0:
                open_events.add(event)
            elif symbol == END and open_events:
                counts[list(open_events)] += 1
                open_events.clear()
    counts[list(open_events)] += 1
    return counts


def _features(column: pa.Array, lexicon: _Lexicon) -> np.ndarray:
    rows = [
        matched_clauses(value.decode("utf-8", "replace").lower(), lexicon) if value else np.zeros(EVENTS)
        for value in column.cast(pa.binary()).to_pylist()
    ]
    counts = np.array(rows).reshape(len(rows), EVENTS)
    return np.hstack([counts > 0, np.log1p(counts)])


def _start() -> Grammar:
    return Grammar({word: symbol for symbol, words in STARTING_WORDS.items() for word in words.split()})


def _learned_insults(sample: DataFrame, least: int, precision: float, most: int) -> tuple[dict[str, int], dict[str, int]]:
    """Words and stems that occur in ``least`` labelled texts or more, of which nearly all are toxic."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    word = F.col("word")
    forms = F.array(
        F.struct(word.alias("form"), F.lit(0).alias("stem")),
        *[
            F.struct(F.when(F.length(word) > n, F.substring(word, 1, n)).alias("form"), F.lit(n).alias("stem"))
            for n in STEM_LENGTHS
        ],
    )
    found = (
        sample.select("doc_id", "toxic", F.explode(words).alias("word"))
        .select("doc_id", "toxic", F.explode(forms).alias("f"))
        .select("doc_id", "toxic", "f.form", "f.stem")
        .where("form IS NOT NULL")
        .distinct()
        .groupBy("form", "stem")
        .agg(F.sum("toxic").alias("toxic"), F.count("*").alias("texts"))
        .where((F.col("toxic") >= least) & (F.col("toxic") >= precision * F.col("texts")))
        .orderBy(F.desc("toxic"), "form", "stem")
        .limit(most)
        .collect()
    )
    stems = {row.form: INSULT for row in found if row.stem}
    covered = {form for form in stems if any(form[:n] in stems for n in STEM_LENGTHS if n < len(form))}
    stems = {form: symbol for form, symbol in stems.items() if form not in covered}
    words_ = {
        row.form: INSULT
        for row in found
        if not row.stem and not any(row.form[:n] in stems for n in STEM_LENGTHS if n <= len(row.form))
    }
    return words_, stems


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-penalised logistic fit by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    shrink = np.full(x.shape[1], penalty)
    shrink[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + shrink * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = 12_000,
    least: int = 6,
    precision: float = 0.95,
    max_entries: int = 4000,
) -> Grammar:
    """Learn from ``doc_id``, ``text`` of ``docs`` and ``doc_id``, ``toxic`` of ``labels``.

    Reads a sample of about ``max_rows`` labelled rows, chosen by a hash of
    doc_id, so its ids can be broadcast; a doc_id labelled twice counts as
    toxic if one label says so. Rows without label or text are left out.
    Without rows of both kinds the starting lists and weights are returned.
    """
    usable = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    scale = 1 << 20
    rate = int(scale * min(1.0, max_rows / max(1, usable.count())))
    chosen = usable.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(scale)) < rate)
    sample = pin(
        docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id"), "labelled"
    )
    grammar = _start()
    words, stems = _learned_insults(sample, least, precision, max_entries)
    grammar.words = words | grammar.words
    grammar.stems = stems

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _Lexicon(grammar)
        for batch in batches:
            rows = _features(batch["text"], lexicon)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rows), pa.list_(pa.float64())), batch["toxic"].cast(pa.float64())], ["x", "y"]
            )

    rows = sample.mapInArrow(tidy(features), "x array<double>, y double").collect()
    y = np.array([row.y for row in rows])
    if len(rows) and 0 < y.sum() < len(y):
        grammar.weights, grammar.bias = _logistic(np.array([row.x for row in rows]), y)
    return grammar


ADDED = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) to every row of ``docs``, from ``text`` alone.

    A null or empty text gets the score of a text without matched clauses.
    Input columns with the added names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(grammar)
    cached: dict[str, _Lexicon] = {}

    def apply(batch: pa.RecordBatch) -> list[pa.Array]:
        known = shared.value
        lexicon = cached.setdefault("lexicon", _Lexicon(known))
        weights = _features(batch["text"], lexicon) @ known.weights + known.bias
        scores = 1 / (1 + np.exp(-np.clip(weights, -30, 30)))
        return [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]

    return with_columns_from_arrow(docs, ADDED, apply)

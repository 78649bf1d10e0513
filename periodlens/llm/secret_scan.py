"""Secret scan: Boolean trigram queries against an inverted index, then the regular expressions on what is left.

A rule's expression is turned once into a query of mandatory trigrams: the
strings that each stretch of it can spell, as an OR of ANDs. Every block of
texts gets an inverted index (trigram to ascending text numbers) of the
trigrams that some rule asks for; the postings are intersected and united, and
only the texts that remain are searched with the expression itself. A rule
without a mandatory trigram searches all texts.

The index is split by document, as the blocks are, so nothing is shuffled and
a lost task is simply run again. Trigrams are of bytes with A-Z lower-cased,
so one index serves rules with and without regard to case.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from re import _constants, _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodlens.llm.common import chunks_by_size, texts_as_bytes, with_columns_from_arrow

#: A stretch of an expression is followed while it spells at most so many strings; beyond, a new stretch begins.
MOST_STRINGS = 64
_ALL = ("all",)


@dataclass(frozen=True)
class Rule:
    """``pattern`` over UTF-8 bytes; a match counts if ``group`` has ``least`` bytes. ``fold``: a-z match A-Z too."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    fold: bool = False

    def compiled(self) -> re.Pattern[bytes]:
        return re.compile(self.pattern.encode(), re.IGNORECASE if self.fold else 0)


# Fixed patterns: the three base kinds, then published forms of keys.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # The runs of 32 or more are the longest runs; shorter ones need not be made to be dropped.
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("api_key", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("pay_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("url_login", r"""://[A-Za-z0-9._~-]+:[^\x00-\x20/@:"'<>\x7F-\xFF]+@[A-Za-z0-9]"""),
)
RULES = BASE_RULES + MORE_RULES

SPAN = T.StructType().add("kind", T.StringType()).add("start", T.LongType()).add("end", T.LongType())
ADDED = T.StructType().add("spans", T.ArrayType(SPAN))


# --- from an expression to a query ----------------------------------------------------------------------------------


def _every(parts: Sequence[tuple]) -> tuple:
    kept = tuple(dict.fromkeys(p for p in parts if p != _ALL))
    return _ALL if not kept else kept[0] if len(kept) == 1 else ("and", kept)


def _some(parts: Sequence[tuple]) -> tuple:
    kept = tuple(dict.fromkeys(parts))
    return _ALL if _ALL in kept or not kept else kept[0] if len(kept) == 1 else ("or", kept)


def _spelling(strings: set[str]) -> tuple:
    """The query that a text with one of ``strings`` in it meets."""
    grams = []
    for data in (s.lower().encode() if s.isascii() else s.encode() for s in strings):
        if len(data) < 3:
            return _ALL
        grams.append(frozenset(data[i] << 16 | data[i + 1] << 8 | data[i + 2] for i in range(len(data) - 2)))
    least = sorted({g for g in grams if not any(other < g for other in grams)}, key=sorted)
    return _some([_every([("has", gram) for gram in sorted(g)]) for g in least])


#: What an element can spell (None: too many strings), its query, and strings it surely begins and ends with.
_Element = tuple[set[str] | None, tuple, set[str], set[str]]
_NOTHING: _Element = (None, _ALL, {""}, {""})


def _element(op, arg) -> _Element:
    if op is _constants.LITERAL:
        return {chr(arg)}, _ALL, {""}, {""}
    if op in (_constants.AT, _constants.ASSERT, _constants.ASSERT_NOT):
        return {""}, _ALL, {""}, {""}
    if op is _constants.IN:
        chars: set[str] = set()
        for kind, value in arg:
            low, high = value if kind is _constants.RANGE else (value, value)
            if kind not in (_constants.RANGE, _constants.LITERAL) or high - low >= MOST_STRINGS:
                return _NOTHING
            chars |= {chr(c) for c in range(low, high + 1)}
        return (chars, _ALL, {""}, {""}) if len(chars) <= MOST_STRINGS else _NOTHING
    if op is _constants.SUBPATTERN:
        return _sequence(arg[3])
    if op is _constants.ATOMIC_GROUP:
        return _sequence(arg)
    if op is _constants.BRANCH:
        ways = [_sequence(way) for way in arg[1]]
        if all(w[0] is not None for w in ways) and sum(len(w[0]) for w in ways) <= MOST_STRINGS:
            return set().union(*(w[0] for w in ways)), _ALL, {""}, {""}
        return None, _some([w[1] if w[0] is None else _spelling(w[0]) for w in ways]), {""}, {""}
    if op in (_constants.MAX_REPEAT, _constants.MIN_REPEAT, _constants.POSSESSIVE_REPEAT):
        least, most, body = arg
        strings, query, first, last = _sequence(body)
        if strings is not None and most == 1:
            return (strings if least else strings | {""}), _ALL, {""}, {""}
        if least == 0:
            return _NOTHING
        if strings is None:
            return None, query, first, last
        if len(strings) ** least > MOST_STRINGS:
            return None, _ALL, strings, strings
        copies = reduce(lambda held, _: {a + b for a in held for b in strings}, range(least), {""})
        return (copies, _ALL, {""}, {""}) if least == most else (None, _ALL, copies, copies)
    return _NOTHING


def _sequence(items) -> _Element:
    held, found, whole, begins = {""}, [], True, {""}
    for op, arg in items:
        strings, query, first, last = _element(op, arg)
        if strings is not None and len(held) * len(strings) <= MOST_STRINGS:
            held = {a + b for a in held for b in strings}
            continue
        if strings is not None:  # carry on with the ends of what was held, as far as that stays small
            ends = {s[-2:] for s in held}
            after = {a + b for a in ends for b in strings} if len(ends) * len(strings) <= MOST_STRINGS else strings
        else:
            after = last
            if len(held) * len(first) <= MOST_STRINGS:
                held = {a + b for a in held for b in first}
            found.append(query)
        if whole:
            begins, whole = held, False
        found.append(_spelling(held))
        held = after
    if whole:
        return held, _ALL, {""}, {""}
    return None, _every([*found, _spelling(held)]), begins, held


def trigram_query(rule: Rule) -> tuple:
    """What every text that the rule matches in must hold: ("has", trigram), ("and" | "or", parts) or ("all",)."""
    strings, query, _, _ = _sequence(_parser.parse(rule.pattern))
    return query if strings is None else _spelling(strings)


def named_trigrams(query: tuple) -> set[int]:
    if query[0] == "has":
        return {query[1]}
    return set().union(*(named_trigrams(part) for part in query[1])) if len(query) > 1 else set()


# --- index of a block of texts --------------------------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WINDOW = 1 << 22


class TrigramIndex:
    """Postings of the wanted trigrams over a block of texts; a text of any length is read in windows."""

    def __init__(self, texts: list[bytes], wanted: np.ndarray, is_wanted: np.ndarray):
        self.size, self.wanted = len(texts), wanted
        places = [np.zeros(0, np.int64)]
        for first, last in chunks_by_size(texts):
            # A byte that UTF-8 never has keeps trigrams from reaching over two texts.
            joined = b"\xff".join(texts[first:last])
            bounds = np.cumsum([0, *(len(t) + 1 for t in texts[first:last])])
            for at in range(0, max(1, len(joined) - 2), _WINDOW):
                data = _LOWER[np.frombuffer(joined, np.uint8, min(_WINDOW + 2, len(joined) - at), at)].astype(np.int32)
                codes = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
                hits = np.flatnonzero(is_wanted[codes])
                slots = np.searchsorted(wanted, codes[hits])
                which = first + np.searchsorted(bounds, hits + at, side="right") - 1
                places.append(np.unique(slots * self.size + which))
        places = np.unique(np.concatenate(places))
        self.starts = np.searchsorted(places, np.arange(len(wanted) + 1) * self.size)
        self.texts = places % max(1, self.size)

    def postings(self, trigram: int) -> np.ndarray:
        slot = int(np.searchsorted(self.wanted, trigram))
        return self.texts[self.starts[slot] : self.starts[slot + 1]]

    def candidates(self, query: tuple) -> np.ndarray:
        """Ascending numbers of the texts that meet ``query``."""
        if query[0] == "has":
            return self.postings(query[1])
        if query[0] == "all":
            return np.arange(self.size)
        parts = [self.candidates(part) for part in query[1]]
        if query[0] == "or":
            return reduce(np.union1d, parts)
        return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), sorted(parts, key=len))


def _to_code_points(text: bytes, offsets: np.ndarray) -> np.ndarray:
    """Numbers of code points before the ascending byte ``offsets``."""
    inner = (np.frombuffer(text, np.uint8) & 0xC0) == 0x80
    edges = np.concatenate([[0], offsets])
    return offsets - np.cumsum([np.count_nonzero(inner[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)])


def find_spans(texts: list[bytes], rules: Sequence[Rule], index: TrigramIndex, queries: Sequence[tuple]) -> Iterator[tuple]:
    """(text, rule, start, end) of all matches, in code points, by text, then start, then the rules' order."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    for number, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        expression = rule.compiled()
        for which in index.candidates(query).tolist():
            for match in expression.finditer(texts[which]):
                if match.end(rule.group) - match.start(rule.group) >= rule.least:
                    found.setdefault(which, []).append((match.start(), number, match.end()))
    for which in sorted(found):
        spans = sorted(found[which])
        offsets = np.unique([x for start, _, end in spans for x in (start, end)])
        points = dict(zip(offsets.tolist(), _to_code_points(texts[which], offsets).tolist(), strict=True))
        for start, number, end in spans:
            yield which, number, points[start], points[end]


# --- the operator ---------------------------------------------------------------------------------------------------


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with ``spans``: kind, start and end (code points, end exclusive) of every match in the whole ``text``.

    Matches of one kind are leftmost and do not overlap; those whose group is
    too short are dropped after matching. Spans come by start, then in the
    rules' order. A null or empty text, like one without matches, has an empty
    list. Repeated rows each get their spans; a column named ``spans`` is
    replaced.
    """
    queries = [trigram_query(rule) for rule in rules]
    wanted = np.array(sorted(set().union(*map(named_trigrams, queries))), dtype=np.int64)
    kinds = [rule.kind for rule in rules]
    span_type = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def add(batch: pa.RecordBatch) -> list[pa.Array]:
        is_wanted = np.zeros(1 << 24, dtype=bool)
        is_wanted[wanted] = True
        texts = texts_as_bytes(batch["text"])
        spans = list(find_spans(texts, rules, TrigramIndex(texts, wanted, is_wanted), queries))
        counts = np.bincount(np.array([s[0] for s in spans], dtype=np.int64), minlength=len(texts))
        values = pa.StructArray.from_arrays(
            [
                pa.array([kinds[s[1]] for s in spans], pa.string()),
                pa.array([s[2] for s in spans], pa.int64()),
                pa.array([s[3] for s in spans], pa.int64()),
            ],
            fields=list(span_type),
        )
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)]

    return with_columns_from_arrow(docs, ADDED, add)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas; empty without spans."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, matches of each base kind, SHA-256 of the base spans, and all spans as text."""
    kinds = [rule.kind for rule in BASE_RULES]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return scanned.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def _both_cases(pattern: str) -> str:
    """``pattern`` with each letter outside brackets and escapes as a class of both cases."""
    return re.sub(r"\\x..|\\.|\[[^\]]*\]|([a-z])", lambda m: f"[{m[1]}{m[1].upper()}]" if m[1] else m[0], pattern)


def oracle_sql() -> str:
    """Matches by splitting at the expression: what stands between them gives their places."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    found = [
        f"""SELECT rid, {number} AS number, '{rule.kind}' AS kind,
            regexp_split_to_array(text, {p}) AS gaps, regexp_extract_all(text, {p}) AS hits,
            regexp_extract_all(text, {p}, {rule.group}) AS parts, {rule.least} AS least FROM t"""
        for number, rule in enumerate(RULES)
        for p in [quoted(_both_cases(rule.pattern) if rule.fold else rule.pattern.replace(r"\x7F-\xFF", r"\x7F-\x{10FFFF}"))]
    ]
    return f"""
    WITH t AS (SELECT row_number() OVER (ORDER BY doc_id) AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    found AS ({' UNION ALL '.join(found)}),
    placed AS (
        SELECT rid, number, kind, least, unnest(list_transform(range(1, len(hits) + 1), lambda i: {{
            'start': list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0),
            'size': length(hits[i]), 'part': length(parts[i])}})) AS s
        FROM found),
    spans AS (
        SELECT rid, number, kind, CAST(s.start AS BIGINT) AS start, kind || ':' || CAST(s.start AS BIGINT) || ':' || CAST(s.start + s.size AS BIGINT) AS shown
        FROM placed WHERE s.part >= least),
    summed AS (
        SELECT rid, count(*) FILTER (number = 0) AS n_assign, count(*) FILTER (number = 1) AS n_access, count(*) FILTER (number = 2) AS n_hex,
            coalesce(string_agg(shown, ',' ORDER BY start, number) FILTER (number < {len(BASE_RULES)}), '') AS base,
            string_agg(shown, ',' ORDER BY start, number) AS spans
        FROM spans GROUP BY rid)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM t LEFT JOIN summed USING (rid)"""

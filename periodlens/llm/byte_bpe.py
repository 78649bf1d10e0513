"""Byte-level BPE encoding and decoding with DuckDB queries in each partition.

A text is split by a pattern, and each piece is encoded by itself: a piece
that is a token as a whole gets that token; any other starts as one row per
byte. A recursive query joins neighbouring rows of a piece with the merge
table, contracts the leftmost pair of the lowest rank, and ends when no piece
has a pair left. Decoding joins ids with the vocabulary and aggregates the
bytes in order of position.

A worker keeps the ids of pieces it has met, those met again longest. A long
piece is cut into chunks that are encoded side by side. Token ids are right for
a whole if each two neighbours are what encoding their joined bytes gives, so
only the seams between chunks are looked at: where two neighbours are not
right, a window around them is encoded anew, and grows until its edges are. So
the work grows with the piece's length. A window that has grown beyond a chunk
(the same letters over and over) takes the same step in a loop of statements
that keeps the last state only, as the recursion keeps all; there all copies of
the lowest pair are contracted at once unless a merge with the new token could
have a lower rank.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from periodlens.llm.common import kept_for, with_columns_from_arrow

#: Bytes of a chunk and of the widest window of a recursion, rows that a recursion may keep, and pieces that a worker
#: keeps and looks up at once: they bound memory and leave results as they are.
_CHUNK = 64
_WIDEST = 512
_ROWS = 3_000_000
_CACHED = 300_000
_BATCH_WORDS = 100_000
_MEMORY = "256MB"
_DECODE_ROWS = 250_000

_RECURSION = """
WITH RECURSIVE state(word, pos, token, right_pos, step) AS (
  SELECT word, pos, token, right_pos, 0 FROM pieces
  UNION ALL
  SELECT s.word, s.pos, CASE WHEN s.pos = b.pos THEN b.merged ELSE s.token END,
         CASE WHEN s.pos = b.pos THEN b.after_pos ELSE s.right_pos END, s.step + 1
  FROM state s JOIN (
    SELECT word, best // 4294967296 AS merged, best // 65536 % 65536 AS pos, best % 65536 AS gone, after_pos
    FROM (
      SELECT l.word, min((m.merged * 65536 + l.pos) * 65536 + r.pos) AS best,
             arg_min(r.right_pos, (m.merged * 65536 + l.pos) * 65536 + r.pos) AS after_pos
      FROM state l JOIN state r ON l.word = r.word AND l.right_pos = r.pos
      JOIN merges m ON m.left_token = l.token AND m.right_token = r.token
      GROUP BY l.word)) b ON s.word = b.word
  WHERE s.pos <> b.gone
)
SELECT word, token FROM state JOIN (SELECT word, max(step) AS step FROM state GROUP BY word) USING (word, step)
ORDER BY word, pos
"""

_LONG_STEP = """
CREATE OR REPLACE TEMP TABLE next_state AS
WITH pairs AS (
  SELECT s.*, m.merged, m.alone, min(m.merged) OVER (PARTITION BY word) AS lowest
  FROM (SELECT *, lead(token) OVER following AS right_token, row_number() OVER following AS row_no
        FROM long_state WINDOW following AS (PARTITION BY word ORDER BY pos)) s
  LEFT JOIN merges m ON m.left_token = s.token AND m.right_token = s.right_token),
runs AS (
  SELECT *, row_no - row_number() OVER (PARTITION BY word ORDER BY row_no) AS run FROM pairs WHERE merged = lowest),
picked AS (
  SELECT word, row_no, lowest FROM (
    SELECT *, row_number() OVER (PARTITION BY word, run ORDER BY row_no) AS place,
           row_number() OVER (PARTITION BY word ORDER BY row_no) AS first_of_all FROM runs)
  WHERE CASE WHEN alone THEN first_of_all = 1 ELSE place % 2 = 1 END)
SELECT p.word, p.pos, coalesce(k.lowest, p.token) AS token
FROM pairs p LEFT JOIN picked k ON k.word = p.word AND k.row_no = p.row_no
WHERE NOT EXISTS (SELECT 1 FROM picked g WHERE g.word = p.word AND g.row_no = p.row_no - 1)
"""

_DECODE = """
SELECT part, string_agg(bytes, '' ORDER BY pos) AS bytes
FROM ids JOIN vocabulary USING (token) GROUP BY part ORDER BY part
"""


@dataclass
class Vocabulary:
    """Tokens by rank; what a task needs to build its tables. 50,000 tokens, about 1 MB."""

    tokens: list[bytes]
    pattern: str


def read_vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read a rank file (base64 token and rank on each line); ranks must be 0, 1, 2, ..."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks have gaps")
    return Vocabulary([ranks[i] for i in range(len(ranks))], pattern)


class Coder:
    """Encoder and decoder of one task."""

    def __init__(self, vocabulary: Vocabulary):
        import duckdb
        import regex

        self.tokens = vocabulary.tokens
        self.ranks = {token: rank for rank, token in enumerate(self.tokens)}
        self.byte_tokens = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.pieces = regex.compile(vocabulary.pattern)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "temp_directory": "", "memory_limit": _MEMORY})
        self.db.execute("SET preserve_insertion_order = false")
        self._load_tables()
        self.known: dict[str, int] = {}
        self.starts, self.lengths, self.asked = (np.zeros(0, np.int64) for _ in range(3))
        self.flat = np.zeros(0, np.int32)
        self._forget()

    def _load_tables(self) -> None:
        rows = [
            (self.ranks[token[:i]], self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        left, right, merged = (np.array(column, dtype=np.int32) for column in zip(*rows, strict=True))
        # A token is contracted alone if it may then merge at a rank below its own.
        alone = np.zeros(len(self.tokens), dtype=bool)
        alone[left[merged < left]] = True
        alone[right[merged < right]] = True
        merges = pa.table({"left_token": left, "right_token": right, "merged": merged.astype(np.int64), "alone": alone[merged]})  # noqa: F841
        vocabulary = pa.table(  # noqa: F841
            {
                "token": np.arange(len(self.tokens), dtype=np.int32),
                "bytes": [token.decode("latin-1") for token in self.tokens],
            }
        )
        for name in ("merges", "vocabulary"):
            self.db.execute(f"CREATE TEMP TABLE {name} AS SELECT * FROM {name}")

    def _forget(self) -> None:
        """Keep the pieces that were asked for again, half of the room at most; all others must be encoded anew."""
        order = np.argsort(-self.asked, kind="stable")[: _CACHED // 2]
        kept = np.zeros(len(self.asked), dtype=bool)
        kept[order[self.asked[order] > 1]] = True
        place = np.cumsum(kept) - 1
        self.known = {word: int(place[i]) for word, i in self.known.items() if kept[i]}
        self.flat = self.flat[np.repeat(kept, self.lengths)]
        self.lengths, self.asked = self.lengths[kept], self.asked[kept] // 2
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.apart: dict[tuple[int, int], bool] = {}

    def _pieces_table(self, texts: list[bytes]) -> pa.Table:
        lengths = np.array([len(text) for text in texts])
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        starts = np.cumsum(lengths) - lengths
        return pa.table(
            {
                "word": np.repeat(np.arange(len(texts), dtype=np.int32), lengths),
                "pos": (np.arange(len(data)) - np.repeat(starts, lengths)).astype(np.int32),
                "token": self.byte_tokens[data].astype(np.int64),
                "right_pos": (np.arange(len(data)) - np.repeat(starts, lengths) + 1).astype(np.int32),
            }
        )

    def _contract(self, texts: list[bytes]) -> list[np.ndarray]:
        """Token ids of each text by contraction alone. Texts share queries as far as the recursion's rows allow."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(texts)
        groups: list[list[int]] = []
        held = 0
        for i in sorted(range(len(texts)), key=lambda i: len(texts[i])):
            # One row for each token and step, so at most half the square of the length.
            rows = len(texts[i]) ** 2 // 2
            if not groups or held + rows > _ROWS:
                groups.append([])
                held = 0
            groups[-1].append(i)
            held += rows
        for group in groups:
            self.db.register("pieces", self._pieces_table([texts[i] for i in group]))
            if len(texts[group[-1]]) <= _WIDEST:
                found = self.db.sql(_RECURSION).to_arrow_table()
            else:
                self.db.execute("CREATE OR REPLACE TEMP TABLE long_state AS SELECT word, pos, token FROM pieces")
                held = -1
                while held != (held := self.db.execute("SELECT count(*) FROM long_state").fetchall()[0][0]):
                    self.db.execute(_LONG_STEP)
                    self.db.execute("DROP TABLE long_state")
                    self.db.execute("ALTER TABLE next_state RENAME TO long_state")
                found = self.db.sql("SELECT word, token FROM long_state ORDER BY word, pos").to_arrow_table()
                self.db.execute("DROP TABLE long_state")
            self.db.unregister("pieces")
            ids = found["token"].to_numpy().astype(np.int32)
            ends = np.cumsum(np.bincount(found["word"].to_numpy(), minlength=len(group)))
            for i, start, end in zip(group, ends - np.diff(ends, prepend=0), ends, strict=True):
                out[i] = ids[start:end]
        return out

    def _bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def _hold(self, pairs: list[tuple[int, int]]) -> list[bool]:
        """Whether the joined bytes of two tokens are encoded as these two."""
        new = list(dict.fromkeys(pair for pair in pairs if pair not in self.apart))
        for pair, ids in zip(new, self._contract([self.tokens[a] + self.tokens[b] for a, b in new]), strict=True):
            self.apart[pair] = ids.tolist() == list(pair)
        return [self.apart[pair] for pair in pairs]

    def _contract_long(self, text: bytes) -> np.ndarray:
        """Token ids of a text of any length: chunks, then windows around the seams that do not hold."""
        parts = self._contract([text[i : i + _CHUNK] for i in range(0, len(text), _CHUNK)])
        ids = np.concatenate(parts)
        # Places between two tokens to look at, each with the reach of its window.
        seams = {int(end): 4 for end in np.cumsum([len(part) for part in parts])[:-1]}
        while seams:
            held = self._hold([(int(ids[at - 1]), int(ids[at])) for at in seams])
            windows: list[list[int]] = []
            for (at, reach), holds in sorted(zip(seams.items(), held, strict=True)):
                if holds:
                    continue
                low, high = max(0, at - reach), min(len(ids), at + reach)
                if windows and low <= windows[-1][1]:
                    low, _, other = windows.pop()
                    reach = max(reach, other)
                windows.append([low, high, reach])
            anew = self._contract([self._bytes(ids[low:high]) for low, high, _ in windows])
            pieces, seams, done, length = [], {}, 0, 0
            for (low, high, reach), found in zip(windows, anew, strict=True):
                pieces += [ids[done:low], found]
                length += low - done
                edges = [length] * (low > 0)
                length += len(found)
                edges += [length] * (high < len(ids))
                for edge in edges:
                    seams[edge] = max(seams.get(edge, 0), 2 * reach)
                done = high
            ids = np.concatenate([*pieces, ids[done:]])
        return ids

    def _learn(self, words: Iterable[str]) -> None:
        whole, short, long_ = [], [], []
        for word in words:
            text = word.encode("utf-8", "surrogatepass")
            if text in self.ranks:
                whole.append((word, self.ranks[text]))
            else:
                (short if len(text) <= _CHUNK else long_).append((word, text))
        found = self._contract([text for _, text in short]) + [self._contract_long(text) for _, text in long_]
        names = [word for word, _ in whole + short + long_]
        base = len(self.lengths)
        self.known.update(zip(names, range(base, base + len(names)), strict=True))
        self.lengths = np.concatenate([self.lengths, np.ones(len(whole), np.int64), np.array([len(x) for x in found], np.int64)])
        self.asked = np.concatenate([self.asked, np.zeros(len(names), np.int64)])
        self.flat = np.concatenate([self.flat, np.array([i for _, i in whole], np.int32), *found])
        self.starts = np.cumsum(self.lengths) - self.lengths

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > _CACHED or len(self.apart) > _CACHED:
            self._forget()
        index = np.fromiter(map(self.known.get, words, itertools.repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(index < 0).tolist()
        if new:
            self._learn(sorted({words[i] for i in new}))
            index[new] = [self.known[words[i]] for i in new]
        self.asked += np.bincount(index, minlength=len(self.asked))
        lengths = self.lengths[index]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.arange(total) + np.repeat(self.starts[index] - (ends - lengths), lengths)
        return self.flat[places], lengths

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        words: list[str] = []
        owners: list[tuple[int, int]] = []

        def flush() -> None:
            if not words:
                return
            ids, lengths = self._ids(words)
            bounds = np.cumsum([0, *lengths])
            at = 0
            for row, count in owners:
                out[row].append(ids[bounds[at] : bounds[at + count]])
                at += count
            words.clear()
            owners.clear()

        for row, text in enumerate(texts):
            if len(text) <= 4_000_000:
                found = self.pieces.findall(text)
                words.extend(found)
                owners.append((row, len(found)))
                if len(words) >= _BATCH_WORDS:
                    flush()
                continue
            stream = (match.group() for match in self.pieces.finditer(text))
            while found := list(itertools.islice(stream, _BATCH_WORDS)):
                words.extend(found)
                owners.append((row, len(found)))
                flush()
        flush()
        return [np.concatenate(parts) if parts else np.zeros(0, np.int32) for parts in out]

    def decode(self, rows: list[np.ndarray]) -> Iterator[list[bytes]]:
        """Bytes of each row of ids, as parts to be joined; rows are cut, so a query sees few ids."""
        parts: list[tuple[int, np.ndarray]] = []
        found: list[list[bytes]] = [[] for _ in rows]
        held = 0

        def flush() -> None:
            if not parts:
                return
            lengths = np.array([len(ids) for _, ids in parts])
            ids = pa.table(  # noqa: F841
                {
                    "part": np.repeat(np.arange(len(parts), dtype=np.int32), lengths),
                    "pos": np.arange(int(lengths.sum()), dtype=np.int32),
                    "token": np.concatenate([ids for _, ids in parts]).astype(np.int32),
                }
            )
            self.db.register("ids", ids)
            for part, text in self.db.execute(_DECODE).fetchall():
                found[parts[part][0]].append(text.encode("latin-1"))
            self.db.unregister("ids")
            parts.clear()

        for row, ids in enumerate(rows):
            for at in range(0, len(ids), _DECODE_ROWS):
                part = ids[at : at + _DECODE_ROWS]
                parts.append((row, part))
                held += len(part)
                if held >= _DECODE_ROWS:
                    flush()
                    held = 0
        flush()
        yield from found


def _owner(vocabulary: Vocabulary) -> tuple[str, int]:
    return "byte_bpe", hash((vocabulary.pattern, tuple(vocabulary.tokens)))


def _texts(column: pa.Array) -> list[str]:
    return ["" if value is None else value.decode("utf-8", "replace") for value in column.cast(pa.binary()).to_pylist()]


def encode(docs: DataFrame, vocabulary: Vocabulary, check: bool = False) -> DataFrame:
    """Add ``tokens`` (ids) and ``n_tokens`` for ``text``; a null text counts as empty.

    With ``check`` also ``whole``: whether decoding the ids gives the text back.

    Whole texts of any length are encoded. Input columns with these names are replaced.
    """
    shared, owner = docs.sparkSession.sparkContext.broadcast(vocabulary), _owner(vocabulary)

    def apply(batch: pa.RecordBatch) -> list[pa.Array]:
        coder, texts = kept_for(owner, lambda: Coder(shared.value)), _texts(batch["text"])
        ids = coder.encode(texts)
        arrays = [pa.array(ids, pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64())]
        if check:
            same = [b"".join(parts) == text.encode() for parts, text in zip(coder.decode(ids), texts, strict=True)]
            arrays.append(pa.array(same, pa.bool_()))
        return arrays

    added = T.StructType(
        [T.StructField("tokens", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]
        + [T.StructField("whole", T.BooleanType())] * check
    )
    return with_columns_from_arrow(docs, added, apply, owner)


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Add ``decoded``, the bytes of ``tokens``; null tokens give no bytes."""
    shared, owner = encoded.sparkSession.sparkContext.broadcast(vocabulary), _owner(vocabulary)

    def apply(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = [
            np.asarray(row if row is not None else [], np.int32)
            for row in batch["tokens"].to_numpy(zero_copy_only=False)
        ]
        return [pa.array([b"".join(parts) for parts in kept_for(owner, lambda: Coder(shared.value)).decode(rows)], pa.binary())]

    return with_columns_from_arrow(encoded, T.StructType([T.StructField("decoded", T.BinaryType())]), apply, owner)


def round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of ``text``, encoded and decoded in one pass."""
    shared, owner = docs.sparkSession.sparkContext.broadcast(vocabulary), _owner(vocabulary)

    def apply(batch: pa.RecordBatch) -> list[pa.Array]:
        coder = kept_for(owner, lambda: Coder(shared.value))
        ids = coder.encode(_texts(batch["text"]))
        digests, decoded = [], []
        for row in ids:
            digests.append(hashlib.sha256(row.astype("<u4").tobytes()).hexdigest())
        for parts in coder.decode(ids):
            digest = hashlib.sha256()
            for part in parts:
                digest.update(part)
            decoded.append(digest.hexdigest())
        return [pa.array([len(row) for row in ids], pa.int64()), pa.array(digests), pa.array(decoded)]

    added = T.StructType(
        [
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return with_columns_from_arrow(docs, added, apply, owner)

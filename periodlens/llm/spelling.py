"""Spelling variants: words one edit apart, found in k-d trees over vectors of letter counts.

A replaced letter lowers one count by one and raises another, an inserted one
raises one: the L1 distance of the vectors is at most two. For each pair of
lengths (equal, or one apart) the words of the first are searched in a k-d
tree of the second. A subtree is left out when its box asks for more than the
one raise and the one fall that an edit allows. What is left must agree in a
bit mask of odd counts, and then letter by letter.

The upper levels of a length's tree are fitted on a bounded sample and deal
all words into blocks: each word is a point of one block and a query of every
block that its search reaches. A block grows its own tree. Blocks with more
points or queries than a cell may hold (many words with the same letters) are
cut into cells that each meet once, so no task holds a whole length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodlens.session import drop_scratch, pin, scratch_path

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: a-z, then U+00C0 to U+00FF.
LETTERS = 26 + 64
_LEAF = 48
_SAME, _SHORTER = 1, 2


def count_words(docs: DataFrame, least: int = 5, shortest: int = 6, every: int = 199) -> DataFrame:
    """``word`` and ``n`` of the words of ``shortest`` letters or more that occur ``least`` times or more.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF in the whole ``text``, A-Z
    lower-cased. Where ``every`` divides the CRC-32 of ``doc_id:word``, one
    letter is deleted, the same in every occurrence in the document. A null
    text has no words, a null ``doc_id`` counts as empty.
    """
    lower = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    # Runs are maximal, so a run with fewer letters is not part of a longer one; deletion only shortens.
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.explode(F.regexp_extract_all(lower, F.lit(f"[a-zÀ-ÿ]{{{shortest},}}"), F.lit(0))).alias("run"),
    )
    crc = runs.select("run", F.crc32(F.concat_ws(":", "doc_id", "run").cast("binary")).alias("h"), F.length("run").alias("size"))
    shorter = F.expr("concat(substring(run, 1, h % size), substring(run, h % size + 2))")
    words = crc.select(F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least)


# --- trees ----------------------------------------------------------------------------------------------------------


def encode(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters of words of one length as a matrix of numbers 0 to 89, and the matrix of their counts."""
    letters = [word.encode("latin-1") for word in words.to_pylist()]
    codes = np.frombuffer(b"".join(letters), np.uint8).reshape(len(letters), -1)
    codes = np.where(codes < 128, codes - 97, codes - (192 - 26)).astype(np.uint8)
    counts = np.zeros((len(letters), LETTERS), dtype=np.int32)
    np.add.at(counts, (np.arange(len(letters))[:, None], codes), 1)
    return codes, counts


class Node:
    """A leaf with the ``rows`` of its points and a ``block`` number, or a split: at most ``limit`` of ``letter``, or more."""

    __slots__ = ("letter", "limit", "low", "high", "rows", "block")

    def __init__(self, rows: np.ndarray):
        self.letter, self.rows, self.block, self.limit, self.low, self.high = -1, rows, 0, 0, None, None


def grow(counts: np.ndarray, leaf: float) -> Node:
    """A tree over the rows of ``counts``, split as evenly as one letter's count can, down to ``leaf`` rows."""
    root = Node(np.arange(len(counts)))
    open_nodes, blocks = [root], 0
    while open_nodes:
        node = open_nodes.pop()
        if len(node.rows) > leaf and len(node.rows) > 1:
            here = counts[node.rows]
            below = np.stack([(here <= limit).sum(axis=0) for limit in range(int(here.max()))])
            uneven = np.abs(2 * below - len(node.rows))
            limit, letter = np.unravel_index(int(uneven.argmin()), uneven.shape)
            if 0 < below[limit, letter] < len(node.rows):
                node.letter, node.limit = int(letter), int(limit)
                low = here[:, letter] <= limit
                node.low, node.high = Node(node.rows[low]), Node(node.rows[~low])
                node.rows = None
                open_nodes += [node.high, node.low]
                continue
        node.block, blocks = blocks, blocks + 1
    return root


def search(root: Node, counts: np.ndarray, falls: bool) -> Iterator[tuple[Node, np.ndarray]]:
    """Leaves whose box has a vector that differs from a query's by one raise and, if ``falls``, one fall at most; with
    each leaf the rows of those queries."""
    unused = np.full(len(counts), -1, dtype=np.int32)
    stack = [(root, np.arange(len(counts)), unused, unused)]
    while stack:
        node, rows, raised, fallen = stack.pop()
        if not len(rows):
            continue
        if node.letter < 0:
            yield node, rows
            continue
        # The nearest vector of the box so far.
        x = counts[rows, node.letter] + (raised == node.letter) - (fallen == node.letter)
        for child, inside, near, paid in (
            (node.low, x <= node.limit, (x == node.limit + 1) & (fallen < 0) & falls, "fallen"),
            (node.high, x > node.limit, (x == node.limit) & (raised < 0), "raised"),
        ):
            go = inside | near
            up, down = raised[go], fallen[go]
            (down if paid == "fallen" else up)[near[go]] = node.letter
            stack.append((child, rows[go], up, down))


def home(root: Node, counts: np.ndarray) -> np.ndarray:
    """The number of the leaf that each vector lies in."""
    blocks = np.zeros(len(counts), dtype=np.int64)
    stack = [(root, np.arange(len(counts)))]
    while stack:
        node, rows = stack.pop()
        if node.letter < 0:
            blocks[rows] = node.block
        else:
            low = counts[rows, node.letter] <= node.limit
            stack += [(node.low, rows[low]), (node.high, rows[~low])]
    return blocks


# --- one edit apart -------------------------------------------------------------------------------------------------


def _odd(counts: np.ndarray) -> np.ndarray:
    """A bit for each letter (some share one), set where its count is odd."""
    bits = np.uint64(1) << (np.arange(LETTERS) % 64).astype(np.uint64)
    return np.bitwise_xor.reduce(np.where(counts & 1, bits, np.uint64(0)), axis=1)


def _one_edit(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Whether each query's letters become the point's by one replacement, or by one insertion if the point is longer."""
    if queries.shape[1] == points.shape[1]:
        return (queries != points).sum(axis=1) == 1
    front = np.logical_and.accumulate(queries == points[:, :-1], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((queries == points[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= queries.shape[1]


def near_pairs(points: pa.Array, queries: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) numbers of all words one edit apart; points have the queries' length or one letter more."""
    none = np.zeros(0, np.int64)
    if not len(points) or not len(queries):
        return none, none
    point_codes, point_counts = encode(points)
    query_codes, query_counts = encode(queries)
    falls = point_codes.shape[1] == query_codes.shape[1]
    point_odd, query_odd = _odd(point_counts), _odd(query_counts)
    found = [(none, none)]
    step = max(1, (1 << 22) // point_codes.shape[1] // _LEAF)
    for leaf, rows in search(grow(point_counts, _LEAF), query_counts, falls):
        for at in range(0, len(rows), step):
            for first in range(0, len(leaf.rows), 1 << 12):
                some, here = rows[at : at + step], leaf.rows[first : first + (1 << 12)]
                differ = np.bitwise_count(query_odd[some][:, None] ^ point_odd[here][None, :])
                q, p = np.nonzero(differ <= (2 if falls else 1))
                q, p = some[q], here[p]
                near = _one_edit(query_codes[q], point_codes[p])
                found.append((q[near], p[near]))
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


# --- the operator ---------------------------------------------------------------------------------------------------


def _upper_trees(words: DataFrame, sizes: dict[int, int], sample: int, block: int) -> dict[int, Node]:
    """A tree for each length, whose leaves hold about ``block`` words; fitted on about ``sample`` words of all."""
    share = max(1, -(-sum(sizes.values()) // sample))
    chosen: dict[int, list[str]] = {}
    for row in words.where(F.pmod(F.xxhash64("word"), F.lit(share)) == 0).select("word", "size").collect():
        chosen.setdefault(row["size"], []).append(row.word)
    trees = {}
    for size, n in sizes.items():
        held = sorted(chosen.get(size, []))
        counts = encode(pa.array(held, pa.string()))[1] if held else np.zeros((0, LETTERS), np.int32)
        trees[size] = _without_rows(grow(counts, block * len(held) / n))
    return trees


def _without_rows(node: Node) -> Node:
    """The tree as it is sent to the tasks."""
    node.rows = None
    if node.letter >= 0:
        _without_rows(node.low)
        _without_rows(node.high)
    return node


def _routed(words: DataFrame, trees: dict[int, Node]) -> DataFrame:
    """Each word as a point (role 0) of its block, and as a query of the blocks that its searches reach."""
    sent = words.sparkSession.sparkContext.broadcast(trees)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = sent.value
        for batch in batches:
            lengths = batch["size"].to_numpy()
            for size in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == size))
                counts = encode(part["word"])[1]
                places = [(size, 0, np.arange(len(counts)), home(upper[size], counts))]
                for role, points in ((_SAME, size), (_SHORTER, size + 1)):
                    if points in upper:
                        for leaf, rows in search(upper[points], counts, role == _SAME):
                            places.append((points, role, rows, np.full(len(rows), leaf.block)))
                for points, role, rows, block in places:
                    taken = part.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(rows), points, np.int32)),
                            pa.array(block.astype(np.int32)),
                            pa.array(np.full(len(rows), role, np.int32)),
                            taken["word"],
                            taken["n"],
                        ],
                        ["points", "block", "role", "word", "n"],
                    )

    return words.select("word", "n", "size").mapInArrow(route, "points int, block int, role int, word string, n long")


def _cells(routed: DataFrame, cell: int) -> DataFrame:
    """``routed`` with the cell of each row: a block of too many points or queries is cut, and every part of its points
    meets every part of its queries once."""
    parts = (
        routed.groupBy("points", "block")
        .agg(F.count_if(F.col("role") == 0).alias("p"), F.count_if(F.col("role") > 0).alias("q"))
        .select(
            "points",
            "block",
            F.ceil(F.col("p") / cell).cast("int").alias("p"),
            F.ceil(F.col("q") / (8 * cell)).cast("int").alias("q"),
        )
        .where("p > 0 AND q > 0")
    )
    own = lambda n: F.pmod(F.xxhash64("word"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    met = routed.join(parts, ["points", "block"])
    points = met.where("role = 0").select("*", own("p").alias("i")).select("*", all_of("q").alias("j"))
    queries = met.where("role > 0").select("*", own("q").alias("j")).select("*", all_of("p").alias("i"))
    return points.unionByName(queries).drop("p", "q")


def _pairs(cells: DataFrame) -> DataFrame:
    """``word``, ``other`` and ``other_n`` for each word and each near word."""

    def compare(cell: pa.Table) -> pa.Table:
        role = cell["role"].to_numpy()
        points = cell.filter(pa.array(role == 0))
        out = {"word": [], "other": [], "other_n": []}
        for kind in (_SAME, _SHORTER):
            queries = cell.filter(pa.array(role == kind))
            q, p = near_pairs(points["word"].combine_chunks(), queries["word"].combine_chunks())
            for one, i, other, j in ((queries, q, points, p), (points, p, queries, q))[: 1 if kind == _SAME else 2]:
                out["word"].append(one["word"].take(pa.array(i)).combine_chunks())
                out["other"].append(other["word"].take(pa.array(j)).combine_chunks())
                out["other_n"].append(other["n"].take(pa.array(j)).combine_chunks())
        return pa.table({name: pa.chunked_array(arrays) for name, arrays in out.items()})

    return cells.groupBy("points", "block", "i", "j").applyInArrow(compare, "word string, other string, other_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last of the chain of forms, for each word that has a form.

    Counts rise along a chain, so it ends. Every round doubles how far each
    word has come, and is written to the shared folder.
    """
    at = pin(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = pin(at.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), "_next"), "roots")
        at = moved.drop("_next")
        if moved.where(F.col("_next").isNotNull()).isEmpty():
            return at


def variants(words: DataFrame, ratio: int = 5, sample: int = 100_000, block: int = 1 << 15) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` for each row of ``word`` and ``n``.

    Words consist of a-z and U+00C0 to U+00FF and come once each. ``n_near``
    counts the words one inserted, deleted or replaced letter away; the most
    frequent of them (ties: the smallest by code points) is the form if it
    has at least ``ratio`` times ``n``. ``root`` follows forms to the last and
    is the word itself where there is none. ``sample`` bounds the words that
    the upper levels of the trees are fitted on; all words are searched.
    """
    spark = words.sparkSession
    words = pin(words.select("word", "n", F.length("word").alias("size")).repartition("word"), "words")
    # One row for each length of a word.
    sizes = {row["size"]: row.n for row in words.groupBy("size").agg(F.count("*").alias("n")).collect()}
    path = scratch_path(spark, "routed")
    routed = _routed(words, _upper_trees(words, sizes, sample, block))
    routed.write.parquet(path)
    routed = spark.read.schema(routed.schema).parquet(path)
    near = (
        _pairs(_cells(routed, block))
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    )
    found = pin(
        words.select("word", "n")
        .join(near, "word", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "best.other", (-F.col("best.less")).alias("other_n"))
        .withColumn("form", F.when(F.col("other_n") >= ratio * F.col("n"), F.col("other")))
        .select("word", "form", "n", "n_near", F.when(F.col("form").isNotNull(), F.col("other_n")).alias("form_n")),
        "forms",
    )
    drop_scratch(spark, path)
    return found.join(_roots(found.where("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def oracle_sql(least: int = 5, shortest: int = 6, every: int = 199, ratio: int = 5) -> str:
    """Words meet by what is left when a letter is masked or deleted."""
    return rf"""
    WITH RECURSIVE crc AS (
        SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
    runs AS (
        SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
        FROM documents),
    apart AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= {shortest} GROUP BY ALL),
    hashed AS (
        SELECT run, n, xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(doc_id || ':' || run, ''),
                lambda ch: CASE WHEN unicode(ch) < 128 THEN [CAST(unicode(ch) AS BIGINT)] ELSE [195, unicode(ch) - 64] END)),
            lambda c, x: xor(c >> 8, steps[1 + (xor(c, x) & 255)]))) AS h
        FROM apart, crc),
    named AS (
        SELECT n, CASE WHEN h % {every} = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word
        FROM hashed),
    words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM named WHERE length(word) >= {shortest} GROUP BY word HAVING sum(n) >= {least}),
    gaps AS (
        SELECT word, i, left(word, i - 1) || '?' || substr(word, i + 1) AS mask, left(word, i - 1) || substr(word, i + 1) AS cut
        FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
    deleted AS (SELECT DISTINCT g.word AS long_word, g.cut AS short_word FROM gaps g JOIN words w ON w.word = g.cut),
    near AS (
        SELECT a.word, b.word AS other FROM gaps a JOIN gaps b ON a.mask = b.mask AND a.i = b.i AND a.word <> b.word
        UNION ALL SELECT long_word, short_word FROM deleted UNION ALL SELECT short_word, long_word FROM deleted),
    best AS (
        SELECT near.word, near.other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near FROM near JOIN words o ON o.word = near.other
        QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, near.other) = 1),
    found AS (
        SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {ratio} * w.n THEN other END AS form,
            CASE WHEN other_n >= {ratio} * w.n THEN other_n END AS form_n
        FROM words w LEFT JOIN best b ON b.word = w.word),
    chain AS (
        SELECT word, word AS root FROM found
        UNION ALL SELECT c.word, f.form FROM chain c JOIN found f ON f.word = c.root WHERE f.form IS NOT NULL)
    SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
    FROM found f JOIN chain c ON c.word = f.word JOIN found e ON e.word = c.root WHERE e.form IS NULL"""

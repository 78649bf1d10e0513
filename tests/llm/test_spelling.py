"""Near words by the trees equal those found by comparing all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from periodlens.llm import spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words, ratio=5):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[word] = best if best and words[best] >= ratio * words[word] else None
    rows = set()
    for word in words:
        root = word
        while form[root]:
            root = form[root]
        rows.add((word, form[word], root, words[word], len(near[word]), words.get(form[word])))
    return rows


def plain_words(rows, least, shortest):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}


def made_words(seed, number=250):
    random.seed(seed)
    words = {}
    for _ in range(number):
        word = "".join(random.choices("abé÷", k=random.randint(3, 7))) if seed % 2 else random.choice(["colour", "naïveté", "zzzzzzzz"])
        for _ in range(random.randint(0, 2)):
            i = random.randrange(len(word))
            word = random.choice([word[:i] + word[i + 1 :], word[:i] + random.choice("abcé") + word[i:], word[:i] + "b" + word[i + 1 :]])
        words[word] = random.choice([5, 5, 6, 25, 30, 150, 4000])
    words.pop("", None)
    return words | {"q" * 300: 5, "q" * 301: 30}


@pytest.mark.parametrize("seed, sample, block", [(1, 100_000, 1 << 15), (2, 100_000, 8), (3, 60, 4), (5, 10, 3)])
def test_variants_equal_plain_ones(spark, seed, sample, block):
    words = made_words(seed)
    table = spark.createDataFrame([(w, n, "x") for w, n in words.items()], "word string, n long, root string")
    found = [tuple(r) for r in spelling.variants(table, 5, sample, block).collect()]
    assert len(found) == len(words) and set(found) == plain_variants(words)


def test_many_words_of_the_same_letters(spark):
    random.seed(4)
    words = {"".join(random.sample("abcdef", 6)): 5 for _ in range(600)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {tuple(r) for r in spelling.variants(table, 5, 100, 16).collect()} == plain_variants(words)


def test_search_reaches_every_edit():
    random.seed(6)
    for size in (1, 2, 5, 9):
        points = sorted({"".join(random.choices("abcdé", k=size)) for _ in range(400)})
        for shift in (0, 1):
            queries = sorted({"".join(random.choices("abcdé", k=size - shift)) for _ in range(300)} - {""})
            pairs = spelling.near_pairs(pa.array(points, pa.string()), pa.array(queries, pa.string()))
            found = {(queries[q], points[p]) for q, p in zip(*pairs, strict=True)}
            assert len(found) == len(pairs[0])
            assert found == {(q, p) for q in queries for p in points if one_edit(q, p)}


def test_boxes_prune():
    random.seed(7)
    words = sorted({"".join(random.choices("abcdefghijklmnop", k=8)) for _ in range(4000)})
    counts = spelling.encode(pa.array(words))[1]
    reached = sum(len(leaf.rows) * len(rows) for leaf, rows in spelling.search(spelling.grow(counts, 48), counts, True))
    assert reached < 0.4 * len(words) ** 2
    assert (spelling.home(spelling.grow(counts, 48), counts) >= 0).all() and np.isfinite(reached)


def test_words_are_counted_as_stated(spark):
    texts = [None, "", "naïveté NAÏVETÉ Colour-colours colour's", "colour " * 7000, "x" * 100_000 + " abcdef7abcdefg ÀÉÎÕÜ÷×"]
    rows = [(i, t) for i, t in enumerate(texts * 9)] + [(None, "colour nullid nullid nullid nullid nullid")] * 2
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int")
    found = {r.word: r.n for r in spelling.count_words(docs).collect()}
    assert found == plain_words(rows, 5, 6)


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "a b c")], "doc_id long, text string")
    assert spelling.variants(spelling.count_words(docs)).count() == 0

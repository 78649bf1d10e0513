"""Dynamic counting equals plain counting of every phrase, however the texts are dealt into shards and blocks."""

import random
import re
from collections import Counter

import pytest

from periodlens.llm import phrases


def plain_counts(rows):
    counts = Counter()
    for lang, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            counts[lang or "und", 0, ""] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang or "und", size, " ".join(words[i : i + size])] += 1
    return counts


def plain_collocations(rows, least, top):
    counts = plain_counts(rows)
    found = {}
    for (lang, size, phrase), a in counts.items():
        if size < 2 or a < least:
            continue
        words = phrase.split(" ")
        cuts = []
        for k in range(1, size):
            left, right = counts[lang, k, " ".join(words[:k])], counts[lang, size - k, " ".join(words[k:])]
            cuts.append((2000000 * a // (left + right), k, left, right))
        found[lang, phrase] = (a, *min(cuts))
    rows = {}
    for (lang, phrase), (a, score, _, left, right) in found.items():
        inside = [
            b[0] for (other, longer), b in found.items()
            if other == lang and longer != phrase and f" {phrase} " in f" {longer} "
        ]
        if not any(100 * b >= 80 * a for b in inside):
            rows.setdefault(lang, []).append((-score, -a, phrase.encode(), left, right))
    return {
        (lang, rank, key.decode(), -a, left, right, counts[lang, 0, ""], -score)
        for lang, entries in rows.items()
        for rank, (score, a, key, left, right) in enumerate(sorted(entries)[:top], 1)
    }


def made_texts(seed, size=60):
    random.seed(seed)
    words = ["New", "york", "city", "hall", "é", "a", "b", "of", "the", "x y", "ÀB"]
    fixed = ["new york city hall", "of the", "New  York\tcity", "a a a a a"]
    texts = []
    for _ in range(size):
        parts = [random.choice([*words, *fixed, random.choice(words) + random.choice(".,;:!?\n\r\x0b")]) for _ in range(random.randint(0, 40))]
        texts.append(" ".join(parts))
    rows = [(random.choice(["en", "fr", None, "und"]), text) for text in texts]
    return [*rows, ("en", None), (None, ""), ("fr", "  ... "), *rows[:10]]


@pytest.mark.parametrize("shards, limit", [(1, 1 << 22), (2, 50), (3, 1 << 22)])
def test_counts_and_collocations_equal_plain_ones(spark, shards, limit):
    rows = made_texts(shards)
    if limit < 1000:
        for size in (7, 50):
            texts = [(t or "").encode() for _, t in rows]
            for length in range(1, 5):
                seen = Counter()
                for block in phrases.blocks(texts, size):
                    for i in block.begins(length):
                        seen[b" ".join(block.data[block.starts[i] : block.ends[i + length - 1]].tobytes().split()).decode(), block.text[i]] += 1
                wanted = Counter()
                for number, (_, text) in enumerate(rows):
                    for (_, n, phrase), count in plain_counts([("x", text)]).items():
                        wanted[phrase, number] += count if n == length else 0
                assert seen == +wanted
    docs = spark.createDataFrame([(*r, "p", 1) for r in rows], "lang string, text string, phrase string, n int")
    found = {(r.lang, r["size"], r.phrase): r.n for r in phrases.count_phrases(docs, 12, shards, 16).collect()}
    assert found == {key: n for key, n in plain_counts(rows).items() if n >= 12 or (key[1] == 0 and n)}
    got = {tuple(r) for r in phrases.collocations(docs, 12, 80, 5, shards).collect()}
    assert got == plain_collocations(rows, 12, 5) and got


def test_few_slots_count_more_and_stay_right(spark):
    rows = made_texts(9)
    docs = spark.createDataFrame(rows, "lang string, text string")
    found = {(r.lang, r["size"], r.phrase): r.n for r in phrases.count_phrases(docs, 12, 3, slot_bits=4).collect()}
    assert found == {key: n for key, n in plain_counts(rows).items() if n >= 12 or (key[1] == 0 and n)}


def test_no_texts(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert phrases.collocations(spark.createDataFrame([("en", None)], "lang string, text string")).count() == 0


def test_phrases_are_taken_from_a_block_at_once():
    words = next(phrases.blocks(["Ein  schöner\tTag , und\tnoch   EINER".encode(), b"", b"a b"]))
    assert phrases._Tight(words).phrases(words.begins(2), 2).to_pylist() == ["ein schöner", "schöner tag", "und noch", "noch einer", "a b"]
    assert phrases._Tight(words).phrases(words.begins(3), 3).to_pylist() == ["ein schöner tag", "und noch einer"]

"""Small tables with nulls, empty and repeated rows, ties, clashing columns; brute force where SQL cannot say it."""

import hashlib
import math
import random
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from periodlens.llm import (
    byte_bpe,
    code_search,
    common,
    embedding_dedup,
    language_id,
    licenses,
    mixing,
    near_dedup,
    neural_lm,
    toxicity,
    url_filter,
)
from periodlens.llm.components import connected_components

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, score string, kept boolean"


def documents(spark, texts, **columns):
    rows = [
        (i, text, columns.get("lang", ["en"] * len(texts))[i], columns.get("source", ["s"] * len(texts))[i], "x", None)
        for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


EDGES = [None, "", "   \n", "12 34 !!", "One two. " * 20_000, "one two three four five six", "one two three four five six"]


def test_no_function_swallows_imports():
    source = "\n".join(p.read_text() for p in Path(common.__file__).parent.glob("*.py"))
    assert "ImportError" not in source and "localCheckpoint" not in source and "crossJoin" not in source


# --- helpers --------------------------------------------------------------------------------------------------------


def test_words_are_hashed_alike_in_pieces():
    random.seed(1)
    text = " ".join("".join(random.choices("abcXYZé\t", k=random.randint(0, 9))) for _ in range(500)).encode()
    texts = [b"", text, b"  ", b"a", b"A\tb", "é".encode() * 300, text]
    whole, bounds = common.hash_words(texts)
    small, small_bounds = common.hash_words(texts, limit=16)
    assert (whole == small).all() and (bounds == small_bounds).all()
    assert np.diff(bounds).tolist() == [len(t.split()) for t in texts]
    known = {}
    for t, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        for word, number in zip(t.lower().split(), whole[a:b].tolist(), strict=True):
            assert known.setdefault(word, number) == number
    assert len(set(known.values())) == len(known)


def test_components(spark):
    random.seed(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 150), (200, 150)]
    random.shuffle(links)
    found = dict(connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect())
    wanted = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {200: 150, 150: 150}
    assert found == wanted
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# --- 1 --------------------------------------------------------------------------------------------------------------


def test_language_edges(spark):
    texts = ["the cat and the dog sat here"] * 3 + ["der hund und die katze liegen dort"] * 3 + EDGES
    langs = ["en"] * 3 + ["de"] * 3 + [None] * len(EDGES)
    docs = documents(spark, texts, lang=langs)
    model = language_id.fit(docs)
    assert model.languages == ["de", "en"]
    rows = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert len(rows) == len(texts)
    assert [rows[i].lang_pred for i in range(6)] == ["en"] * 3 + ["de"] * 3
    assert [rows[i].lang_pred for i in range(6, 10)] == ["und"] * 4 and rows[6].score == 0
    assert all(0 <= r.score <= 1 for r in rows.values())
    nothing = language_id.fit(docs.where("false"))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(docs.where("false"), model).count() == 0


def test_language_with_little_text_keeps_what_was_seen_once(spark):
    english = [f"the cat number {i} and the dog sat here" for i in range(40)]
    docs = documents(spark, [*english, "der flinke hund jagt bunte vögel"], lang=["en"] * 40 + ["de"])
    model = language_id.fit(docs)
    rows = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert rows[40].lang_pred == "de" and rows[40].bits_per_byte < 8 and rows[0].lang_pred == "en"
    # Nothing repeats: the texts still teach their languages, and the pipeline keeps them.
    tiny = documents(spark, ["quick fox", "jagd zum"], lang=["en", "de"])
    found = language_id.identify(tiny, language_id.fit(tiny))
    assert [r.lang_pred for r in found.where(language_id.accepted()).orderBy("doc_id").collect()] == ["en", "de"]


def test_code_lengths_are_normalised_and_alike_in_pieces(spark):
    model = language_id.fit(common.read_table(spark, FOLDER, "documents"))
    kinds = sorted(set(language_id._FOLD.tolist()))
    for context in (b"", b"t", b"th", b"the", "ü".encode(), b"zqzq"):
        before = model.code_lengths([context])[0]
        after = np.array([model.code_lengths([context + bytes([k])])[0] for k in kinds])
        # The bytes no language has seen share what is left; they are coded as one of 256.
        assert ((2.0 ** -(after - before)).sum(axis=0) < 1.001).all()
    text = ("Wir gehen nach Hause, the end. " * 80_000).encode()
    halves = model.code_lengths([text])[0]
    parts = model._bits_of(language_id._FOLD[np.frombuffer(b"\0\0\0" + text, np.uint8)]).sum(axis=0, dtype=np.float64)
    assert np.allclose(halves, parts, rtol=1e-5)


def test_language_held_out_accuracy(spark):
    docs = common.read_table(spark, "/root/testdata/sf0.01", "documents").withColumn("held_out", common.held_out(4, 2))
    model = language_id.fit(docs.where("NOT held_out"))
    found = language_id.identify(docs.where("held_out"), model).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert found.first()[0] > 0.97


# --- 2 and 4 --------------------------------------------------------------------------------------------------------


def test_code_search_equals_brute_force(spark):
    random.seed(3)
    codes = [random.getrandbits(64) - (1 << 63) for _ in range(150)]
    codes += [c ^ (1 << random.randrange(63)) for c in codes[:60]] + codes[:30] + [codes[0]] * 40
    rows = [(i, c) for i, c in enumerate(codes)] + [(5, codes[5]), (None, codes[1]), (999, None)]
    table = spark.createDataFrame(rows, "vec_id long, code long")
    got = code_search.nearest(table, table.where("vec_id % 10 = 0"), k=7).collect()
    found = {}
    for r in sorted(got, key=lambda r: r.rank):
        found.setdefault(r.query_id, []).append((r.distance, r.vec_id))
    for query in range(0, len(codes), 10):
        wanted = sorted((bin((codes[query] ^ c) & (2**64 - 1)).count("1"), i) for i, c in enumerate(codes) if i != query)[:7]
        assert found[query] == wanted
    assert code_search.nearest(table.where("false"), table.where("false")).count() == 0


def test_binary_code_edges(spark):
    rows = [(0, None), (1, []), (2, [1.0, None]), (3, [float("nan")]), (4, [1.0, -1.0, 2.0]), (5, [0.0] * 64 + [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, e array<double>")
    codes = dict(table.select("vec_id", code_search.binary_code(F.col("e"))).collect())
    assert codes == {0: None, 1: None, 2: None, 3: None, 4: 5, 5: 1}


def test_licenses(spark):
    mit = licenses.KNOWN_TEXTS[0][1]
    texts = [
        "Copyright (c) 2020 A. Person\n" + mit.replace(" ", "  ").upper(),
        "Some prose.\nReleased under the MIT Licence!\nAll rights reserved\nreleased under the mit license.\n",
        "Released under the MIT License. More words follow here",
        *EDGES,
    ]
    docs = documents(spark, texts).withColumn("license", F.lit("old"))
    rows = sorted(licenses.scan(docs).collect(), key=lambda r: r.doc_id)
    assert len(rows) == len(texts) and rows[0].license == "MIT"
    assert rows[1].license is None and rows[1].notices == "MIT,proprietary"
    assert rows[2].notices == "" and rows[3].digest is None and rows[3].notices is None
    assert rows[4].digest == hashlib.sha256(b"").hexdigest() == rows[5].digest
    assert licenses.scan(docs.where("false")).count() == 0


def test_usual_licence_files_and_headers(spark):
    folder = Path(licenses.__file__).parent / "license_texts"
    files = {path.stem: path.read_text() for path in sorted(folder.glob("*.txt"))}
    apache = files["Apache-2.0"]
    known = dict(reversed(licenses.KNOWN_TEXTS[:3]))
    bsd = licenses._BSD.format("1. ", "2. ", "3. " + licenses._ENDORSE.format("holder"), "HOLDER")
    header = apache[apache.index("   Licensed under the Apache License, Version 2.0 (the") :]
    wanted = [
        *files.items(),
        ("MIT", "MIT License\n\nCopyright (c) 2020 A. Person\n\n" + known["MIT"]),
        ("MIT", "(The MIT License)\n\nCopyright (c) 2020 A. Person\n\n" + known["MIT"]),
        ("ISC", "ISC License\n\nCopyright (c) 2020, A. Person\n\n" + known["ISC"]),
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, A. Person\n\n" + bsd),
        ("Apache-2.0", apache[: apache.index("   APPENDIX")]),
        ("Apache-2.0", apache.replace("[yyyy] [name of copyright owner]", "2020 A. Person")),
        ("Apache-2.0", "Copyright 2020 A. Person\n\n" + header),
    ]
    docs = documents(spark, [*(text for _, text in wanted), "# " + header.replace("\n", "\n# ") + "\nx = 1\n", "// SPDX-License-Identifier: MIT\nx"])
    rows = sorted(licenses.scan(docs).collect(), key=lambda r: r.doc_id)
    assert [row.license for row in rows] == [*(name for name, _ in wanted), None, None]
    assert [row.notices for row in rows[-2:]] == ["Apache-2.0", "MIT"]


# --- 3 --------------------------------------------------------------------------------------------------------------


def test_transducers_compose():
    grammar = toxicity.Grammar({"idiot": toxicity.INSULT, "you": toxicity.TARGET, "not": toxicity.NEGATION, "said": toxicity.REPORT})

    def events(text):
        return np.flatnonzero(toxicity.matched_clauses(text, toxicity._Lexicon(grammar))).tolist()

    assert events("an idiot") == [0]
    assert events("you idiot. idiot") == [0, 4]
    assert events("you are not an idiot") == [6]
    assert events("you are not one two three four idiot") == [4]
    assert events("they said you idiot. fine") == [5]
    assert events("said. idiot") == [0]
    assert events("") == events("you") == []


def test_toxicity_edges_and_accuracy(spark):
    docs, labels = (common.read_table(spark, "/root/testdata/sf0.01", name) for name in ("documents", "labels"))
    grammar = toxicity.fit(docs, labels.where(~common.held_out(5, 0)))
    judged = toxicity.score(docs, grammar).join(labels.where(common.held_out(5, 0)), "doc_id")
    right = judged.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert right > 0.95
    rows = toxicity.score(documents(spark, EDGES), grammar).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    plain = toxicity.fit(docs, labels.where("false"))
    assert plain.stems == {} and toxicity.score(docs.where("false"), plain).count() == 0


# --- 5 --------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    tokenizers = pytest.importorskip("public_tokenizers")
    return byte_bpe.read_vocabulary(tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)


def test_bpe_equals_tiktoken(spark, vocabulary):
    tiktoken = pytest.importorskip("tiktoken")
    encoding = tiktoken.Encoding(
        "own", pat_str=vocabulary.pattern, mergeable_ranks={t: i for i, t in enumerate(vocabulary.tokens)}, special_tokens={}
    )
    random.seed(4)
    hard = [
        *EDGES[:4], "a" * 3000, " " * 900 + "x", "漢字かな" * 50, "😀é" * 80, "don't I'LL", "\0\0a\0", "<|endoftext|>",
        "".join(random.choices("etaoin", k=300)), "".join(chr(random.randrange(1, 0x3000)) for _ in range(500)),
    ]
    docs = documents(spark, hard).withColumn("tokens", F.lit("old"))
    rows = {r.doc_id: r for r in byte_bpe.round_trip(docs, vocabulary).collect()}
    ids = {r.doc_id: r.tokens for r in byte_bpe.encode(docs, vocabulary).collect()}
    for i, text in enumerate(hard):
        wanted = encoding.encode_ordinary(text or "")
        assert ids[i] == wanted and rows[i].n_tokens == len(wanted)
        assert rows[i].ids_sha256 == hashlib.sha256(np.array(wanted, "<u4").tobytes()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert byte_bpe.encode(docs.where("false"), vocabulary).count() == 0


# --- 6 --------------------------------------------------------------------------------------------------------------


def test_mixing(spark):
    texts = ["w " * n for n in (500, 300, 900, 40, 0, 700)] * 3 + [None, "a b c", "a b c"]
    sources = (["b", "b", "a", None, "a", "c"] * 3) + ["a", None, None]
    docs = documents(spark, texts, source=sources)
    mixture = mixing.mix(docs, block_words=16)
    rows = mixing.taken_words(mixture).collect()
    again = mixing.taken_words(mixing.mix(docs.repartition(5), block_words=16)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == len(texts)
    assert all(r.taken <= 2 * r["size"] for r in rows)
    target, taken = {}, Counter()
    for r in rows:
        target[r.source] = (r.target, r.source_size)
        taken[r.source] += r.taken
    assert math.isclose(sum(t for t, _ in target.values()), 1.5 * sum(r["size"] for r in rows))
    assert all(abs(taken[s] - t) <= 16 and t <= 2 * size for s, (t, size) in target.items())
    # a, b, c and null weigh 5, 2, 1 and 5.
    assert target["a"][0] == 2 * target["a"][1] and target[None][0] == 2 * target[None][1]
    assert math.isclose(target["b"][0], 2 * target["c"][0]) or target["b"][0] == 2 * target["b"][1]
    assert mixing.taken_words(mixing.mix(docs.where("false"))).count() == 0


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 64, 501):
        table = spark.range(n).select(
            mixing.permute(F.col("id"), F.lit(n).cast("long"), mixing.permutation_rounds(F.lit(n).cast("long"), F.lit(3).cast("long"))).alias("x")
        )
        found = [r.x for r in table.collect()]
        assert sorted(found) == list(range(n)) and (n < 50 or found != list(range(n)))


# --- 7 --------------------------------------------------------------------------------------------------------------


def test_url_rules_and_words(spark):
    urls = [
        "http://A.Example.ORG/es/1", "http://example.org/en/15", "http://example.org/en/2", "http://example.orgx/es/", "http://x.com/de/",
        "http://x.com/fr/a", "http://freepokercasino.net/x", "http://plain.net/page", "no host", None, "", "http://a.org", "x://y.com?/de/",
        "http://poker.net/a", "http://casino.net/b", "http://fine.net/casino", "http://freepokercasino.net/x",
    ]
    pages = spark.createDataFrame(
        [(i, u, "<title>plain page here</title>" if i % 2 else None, "v") for i, u in enumerate(urls)],
        "page_id long, url string, html string, verdict string",
    )
    rows = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert len(rows) == len(urls)
    assert [rows[i].rule for i in range(6)] == ["example.org/es/", "example.org/en/1", "org/", None, "com/de/", "com/fr/"]
    assert [rows[i].verdict for i in (0, 1, 2, 4, 5)] == ["block", "block", "allow", "block", "allow"]
    assert rows[0].host == "a.example.org" and rows[0].path == "/es/1"
    assert rows[6].verdict == rows[13].verdict == rows[16].verdict == "block" and rows[7].verdict == "allow"
    assert (rows[9].host, rows[9].path, rows[9].verdict) == ("", "", "allow") and rows[8].host == ""
    assert (rows[11].path, rows[11].rule) == ("", None) and (rows[12].host, rows[12].path) == ("y.com", "")
    assert url_filter.judge(pages.where("false")).count() == 0


def test_viterbi_equals_all_splits():
    counts = {"ab": 50, "a": 10, "b": 4, "abc": 3, "c": 9, "bc": 30}
    total = sum(counts.values())

    def cost(words):
        return sum(math.log(total / counts[w]) if w in counts else math.log(total) + len(w) * math.log(10) for w in words)

    for run in ("abcab", "xabx", "ccc", "bcbcab", "z"):
        splits = []
        for bits in range(1 << (len(run) - 1)):
            words, start = [], 0
            for i in range(1, len(run) + 1):
                if i == len(run) or bits >> (i - 1) & 1:
                    words.append(run[start:i])
                    start = i
            splits.append(cost(words))
        known = {(i, n): counts[run[i : i + n]] for i in range(len(run)) for n in range(1, len(run) + 1) if run[i : i + n] in counts}
        assert math.isclose(cost(url_filter.best_split(run, known, total)), min(splits))


# --- 8 --------------------------------------------------------------------------------------------------------------


def test_embeddings_equal_brute_force(spark):
    random = np.random.default_rng(5)
    base = random.normal(size=(40, 16))
    vectors = [v.tolist() for v in base] + [(base[0] + random.normal(size=16) * 0.15).tolist() for _ in range(60)]
    vectors += [base[1].tolist()] * 5 + [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, (base[1] * 3).tolist(), [1.0, 2.0]]
    labels = [1] * len(vectors)
    labels[10], labels[11], labels[101] = None, 2, 2
    rows = [(i, v, x, "x") for i, (v, x) in enumerate(zip(vectors, labels, strict=True))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, kept string")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(table, block=16).collect()}
    good = [
        i for i, (v, x) in enumerate(zip(vectors, labels, strict=True))
        if x is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)
    ]
    parent = list(range(len(vectors)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for a in good:
        for b in good:
            if a < b and labels[a] == labels[b] and len(vectors[a]) == len(vectors[b]):
                x, y = np.array(vectors[a]), np.array(vectors[b])
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                    links[a] += 1
                    links[b] += 1
                    p, q = sorted((find(a), find(b)))
                    parent[q] = p
    for i in range(len(vectors)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (links[i], find(i), find(i) == i)
    assert embedding_dedup.near_duplicates(table.where("false")).count() == 0


# --- 9 --------------------------------------------------------------------------------------------------------------


def brute_components(texts):
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()})
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            common_ = len(sets[a] & sets[b])
            if common_ and 100 * common_ >= 75 * (len(sets[a]) + len(sets[b]) - common_):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def test_near_duplicates_equal_brute_force(spark):
    random.seed(6)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(25):
        base = random.choices(words, k=random.randint(8, 120))
        texts.append(" ".join(base))
        for _ in range(random.choice((0, 1, 2, 12))):
            copy = list(base)
            for _ in range(random.randint(0, 3)):
                copy[random.randrange(len(copy))] = random.choice(words)
            texts.append("  ".join(copy).upper())
    texts += [None, "", " \n", "one", "ONE", "one two", "a b c d e", "a b c d e f"]
    docs = documents(spark, texts)
    sizes, wanted = brute_components(texts)
    rows = {r.doc_id: r for r in near_dedup.near_duplicates(docs).collect()}
    assert [rows[i].n_shingles for i in range(len(texts))] == sizes
    assert [rows[i].component_id for i in range(len(texts))] == wanted
    assert [rows[i].kept for i in range(len(texts))] == [i == w for i, w in enumerate(wanted)]
    kept = near_dedup.keep_one(docs.unionByName(docs))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(wanted))
    assert kept.columns == docs.columns
    assert near_dedup.near_duplicates(docs.where("false")).count() == 0


def test_sketch_estimates_similarity():
    random = np.random.default_rng(7)
    pool = np.unique(random.integers(0, 1 << 63, 6000, dtype=np.uint64))
    for shared, own in ((900, 50), (500, 250), (300, 600)):
        a, b = pool[: shared + own], np.concatenate([pool[:shared], pool[3000 : 3000 + own]])
        registers = near_dedup.sketches([a, b, np.zeros(0, np.uint64)], piece=256)
        found = near_dedup.likely_similarity(registers[:1], registers[1:2], np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(found - shared / (shared + 2 * own)) < 0.2
        merged = near_dedup.sketches([np.union1d(a, b)])[0]
        assert (merged == np.maximum(registers[0], registers[1])).all() and not registers[2].any()
        bands = near_dedup._as_bands(registers)
        assert (near_dedup._as_registers(bands) == registers).all()


# --- 10 -------------------------------------------------------------------------------------------------------------


def test_language_model_base_and_normalisation(spark):
    docs = common.read_table(spark, FOLDER, "documents").select("doc_id", "text").unionByName(
        documents(spark, [None, "", "never-seen words", "the the"]).selectExpr("doc_id + 1000000 AS doc_id", "text")
    )
    docs = docs.withColumn("held_out", common.held_out(7, 2)).withColumn("score", F.lit("old"))
    training = docs.where("NOT held_out")
    rows = {r.doc_id: r for r in neural_lm.score_texts(docs, training).collect()}
    tokens, counts = {}, Counter()
    for r in docs.collect():
        tokens[r.doc_id] = (r.text or "").encode().lower().split() + [None]
        if zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            counts.update(tokens[r.doc_id])
    total, kinds = sum(counts.values()), len(counts)
    for key, words in tokens.items():
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words)
        assert math.isclose(rows[key].base_score, base, rel_tol=1e-9)
        assert (rows[key].n_tokens, rows[key].train_tokens) == (len(words), total)
        assert rows[key].n_known == sum(counts[w] > 0 for w in words) and rows[key].score < 0
    # Over all words and one unseen word of each class, the probabilities after any text add up to one.
    counted = neural_lm.count_words(training)
    small, least = neural_lm.build_vocabulary(counted, frequent=300)
    assert 0 < len(small.hashes) <= 300 and least > 1
    model = neural_lm.fit(training, small, rounds=1)
    every = np.arange(neural_lm.SYMBOLS)
    start = np.full(neural_lm.SYMBOLS, neural_lm.START)
    assert math.isclose(np.exp(neural_lm.log_probabilities(model, start, start, every)).sum(), 1, rel_tol=1e-4)
    whole, _ = neural_lm.build_vocabulary(counted)
    a = {r.doc_id: r for r in neural_lm.score(docs, counted, whole, 1, model).collect()}
    b = {r.doc_id: r for r in neural_lm.score(docs, counted, small, least, model).collect()}
    assert all(math.isclose(a[k].score, b[k].score, rel_tol=1e-6) and a[k].n_known == b[k].n_known for k in a)


def test_language_model_without_training_rows(spark):
    docs = documents(spark, EDGES).select("doc_id", "text")
    rows = neural_lm.score_texts(docs, docs.where("false")).collect()
    assert len(rows) == len(EDGES) and all(r.base_score == 0 and r.n_known == 0 for r in rows)
    assert neural_lm.score_texts(docs.where("false"), docs).count() == 0


def test_language_model_learns_from_every_text(spark):
    docs = documents(spark, [f"text number {i} of a small set" for i in range(40)])
    vocabulary, _ = neural_lm.build_vocabulary(neural_lm.count_words(docs))
    # Texts of all residues of the hash that a share of the corpus was once picked by.
    residue = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 20))
    start = neural_lm.starting_parameters(vocabulary.unigram).flat()
    for quarter in range(4):
        some = docs.where((residue >= quarter << 18) & (residue < (quarter + 1) << 18))
        assert some.count() > 0 and (neural_lm.fit(some, vocabulary, rounds=1).flat() != start).any()


# --- pipeline and SQL -----------------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = common.read_table(spark, FOLDER, "documents").withColumn("score", F.lit("own"))
    docs = docs.unionByName(documents(spark, EDGES).selectExpr("doc_id + 900000 AS doc_id", "text", "lang", "source", "0L AS n_chars", "'own' AS score"))
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, FOLDER)
        assert after.columns == docs.columns and after.where("score = 'own'").count() == after.count() > 0, name
        before = after
    assert [name for name, _ in corpus_pipeline.STAGES][2] == "one_of_each_group"
    result = corpus_pipeline.run(spark, FOLDER)
    assert result.count() > 0 and result.where("NOT whole").count() == 0


@pytest.mark.parametrize("name", ["op2_code_search", "op4_licenses", "op6_mixing"])
def test_query_equals_sql(spark, name):
    from periodlens.llm import registered

    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = connection.execute(registered.oracle_sql()[name])
    names = [column[0] for column in result.description]
    found = registered.queries()[name](spark, FOLDER)
    assert sorted(names) == sorted(found.columns)
    key = lambda row: tuple(str(v) for v in row)
    rows = sorted((tuple(r) for r in found.select(*names).collect()), key=key)
    for got, wanted in zip(rows, sorted(result.fetchall(), key=key), strict=True):
        for x, y in zip(got, wanted, strict=True):
            assert x == y or isinstance(x, float) and math.isclose(x, y, rel_tol=1e-12)


# --- cases that lost text -------------------------------------------------------------------------------------------


def test_copyright_statements_end_with_their_sentence(spark):
    mit = dict(licenses.KNOWN_TEXTS)["MIT"]
    texts = [
        "Copyright (c) 2020 Jane Doe. All rights reserved.",
        "Copyright 2020 A. anything one",
        "Copyright 2021 B. something else",
        "Copyright 2021 J. R. Doe and Foo Inc., Bar Ltd. All rights reserved.",
        f"Copyright (c) 2020 J. Doe\n{mit}",
        f"Copyright (c) 2020-2021, Example.com Inc. All rights reserved.\n{mit}",
        f"Copyright (c) 2020 Jane Doe. {mit}",
        f"Copyright (c) 2020 Jane Doe, all rights reserved\n{mit}",
        "copyright 2020 x. " + "word. " * 50_000,
        "(c) 2019 me\nanything one",
        None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan(docs).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert found[0].notices == "proprietary" and found[0].digest == empty
    assert found[1].digest == hashlib.sha256(b"anything one").hexdigest() == found[9].digest
    assert found[2].digest == hashlib.sha256(b"something else").hexdigest()
    assert found[3].digest == empty and found[3].notices == "proprietary"
    assert [found[i].license for i in (4, 5, 6, 7)] == ["MIT"] * 4
    assert found[8].digest == hashlib.sha256(("word " * 50_000).strip().encode()).hexdigest()
    connection = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841
    rows = connection.execute(licenses.oracle_sql()).fetchall()
    assert {r[0]: r[1:] for r in rows} == {i: (r.digest, r.license, r.notices) for i, r in found.items()}


def test_a_language_of_few_long_texts_is_learned(spark):
    random.seed(5)
    english = [" ".join(random.choices("the of and house water strong thing with about".split(), k=350_000)) for _ in range(3)]
    spanish = ["la casa de los perros y el agua fuerte " * 20] * 50
    rows = [(text, "en") for text in english] + [(text, "es") for text in spanish] + [("", "xx"), (None, "en")]
    table = spark.createDataFrame(rows, "text string, lang string")
    for sample in (200_000, 1):
        model = language_id.fit(table, sample_bytes=sample)
        assert model.languages == ["en", "es"]
        tests = spark.createDataFrame([("the strong house about water",), ("los perros y la casa",)], "text string")
        found = language_id.identify(tests, model)
        assert [r.lang_pred for r in found.collect()] == ["en", "es"]
        assert found.where(language_id.accepted()).count() == 2


def test_vectors_of_any_size_are_linked(spark):
    rows = []
    for i, size in enumerate((1e200, 1e-200, 1e-320, 1.7e308)):
        rows += [(2 * i, [size, size / 2], i), (2 * i + 1, [size, size / 2], i), (100 + i, [size, -size], i)]
    rows += [(200, [0.0, -0.0], 0), (201, [0.0, 0.0], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(table).collect()}
    assert [found[i].n_links for i in range(8)] == [1] * 8 and found[3].component_id == 2
    assert all(found[i].n_links == 0 for i in (100, 101, 102, 103, 200, 201))


def test_long_pieces_are_encoded_in_linear_time():
    import time

    import public_tokenizers
    import tiktoken

    vocabulary = byte_bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    ranks = {token: rank for rank, token in enumerate(vocabulary.tokens)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = byte_bpe.Coder(vocabulary)
    random.seed(8)
    alphabets = ["ab", "aeinrst", "abcdefghijklmnopqrstuvwxyz", "éèàab", "ACGT"]
    texts = ["".join(random.choices(a, k=n)) for a in alphabets for n in (65, 130, 700, 3000)]
    texts += [(random.choice(alphabets)[: random.randint(1, 4)] * 3000)[:2000] for _ in range(10)] + ["a" * 100_000, "abab" * 5000 + "b"]
    texts += ["".join(random.choice(a) * random.randint(1, 70) for _ in range(40)) for a in alphabets]
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert ids.tolist() == library.encode_ordinary(text)
    long_ = "".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    began = time.perf_counter()
    ids = coder.encode([long_])[0]
    assert time.perf_counter() - began < 60 and ids.tolist() == library.encode_ordinary(long_)


def test_pieces_may_be_forgotten(monkeypatch):
    import public_tokenizers

    vocabulary = byte_bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    random.seed(9)
    texts = [" ".join("".join(random.choices("abcdefgh", k=random.randint(3, 12))) for _ in range(80)) for _ in range(60)]
    whole = [ids.tolist() for ids in byte_bpe.Coder(vocabulary).encode(texts)]
    monkeypatch.setattr(byte_bpe, "_CACHED", 200)
    monkeypatch.setattr(byte_bpe, "_BATCH_WORDS", 100)
    small = byte_bpe.Coder(vocabulary)
    assert [ids.tolist() for ids in small.encode(texts + texts[::-1])] == whole + whole[::-1]
    assert len(small.known) < 1000


def test_kept_state_goes_when_another_owner_begins():
    first = common.kept_for("a", lambda: [1])
    common.release("a")
    assert common.kept_for("a", lambda: [2]) is first
    common.release("b")
    assert common.kept_for("a", lambda: [3]) == [3]
    common.release()

"""The operators of one text at a time: encoding, quality, rules, toxicity, language model."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from playmill.llm import lm_scoring, quality_classifier, quality_rules, queries, sp_codec, toxicity

ODD = [None, "", " ", "a", "  two  spaces ", "▁mark ▁", "\n\ttab\r\n", "日本語 😀 \x00", "<s> <0x0A>", "x" * 3000, "word " * 3000]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", None, 1, "clash") for i, t in enumerate(ODD)] + [(3, "a", None, "s", None, None), (None, "null id", "en", "s", 1, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")


def test_codec_equals_the_library(odd):
    import sentencepiece

    path = queries.tokenizer_path()
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = sp_codec.decode(sp_codec.encode(odd, path), path).collect()
    assert len(rows) == odd.count()
    texts = {(r["doc_id"], r["text"]): r["text"] or "" for r in odd.collect()}
    by_id = {}
    for (i, _), t in texts.items():
        by_id.setdefault(i, []).append(t)
    for r in rows:
        t = by_id[r["doc_id"]][0]
        assert r["ids"] == sp.encode(t)
        assert r["decoded"] == sp.decode(r["ids"])
        raw = t.encode()
        assert all(0 <= a <= b <= len(raw) for a, b in zip(r["begins"], r["ends"]))
        if raw:
            assert r["ends"][-1] == len(raw) and all(a <= b for a, b in zip(r["ends"], r["begins"][1:]))


def test_codec_of_an_empty_table(odd):
    path = queries.tokenizer_path()
    assert sp_codec.decode(sp_codec.encode(odd.limit(0), path), path).count() == 0


def test_character_map_longest_prefix():
    """A trie of two entries, a -> b and ab -> c, built by hand in the compiled layout."""
    import struct

    units = [0] * 1024

    def unit(label=0, offset=0, leaf=False):
        return label | (1 << 8 if leaf else 0) | offset << 10

    units[0] = unit(offset=1)
    node_a = 0 ^ 1 ^ ord("a")
    units[node_a] = unit(ord("a"), node_a ^ 512, True)
    units[512] = 1 << 31 | 0
    node_ab = 512 ^ ord("b")
    units[node_ab] = unit(ord("b"), node_ab ^ 800, True)
    units[800] = 1 << 31 | 2
    blob = struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + b"b\0c\0"
    m = sp_codec.CharacterMap(blob)
    assert m.longest(b"abx", 0) == (2, b"c")
    assert m.longest(b"ax", 0) == (1, b"b")
    assert m.longest(b"xa", 0) is None


def brute_repeats(words):
    n = len(words)
    out = [0] * n
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            out[i] = max(out[i], k)
    return out


def test_longest_repeats():
    rng = random.Random(5)
    for _ in range(60):
        each = [[rng.randrange(rng.choice([1, 2, 5])) for _ in range(rng.randrange(20))] for _ in range(3)]
        got = quality_rules.longest_repeats(np.array(sum(each, []), np.int64), np.repeat(np.arange(3), list(map(len, each))))
        assert got.tolist() == sum(map(brute_repeats, each), [])


def test_quality_rules_base(spark, odd, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").limit(60).union(odd.select("doc_id", "text"))
    got = quality_rules.judge(quality_rules.measure(docs))
    assert got.count() == docs.count()
    want = Counter()
    for r in docs.collect():
        text = r["text"] or ""
        words = text.encode().split()
        lines = [x for x in text.split("\n") if x.encode().split()]
        seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        hit = {i + k for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for k in range(8)}
        want[r["doc_id"], len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), len(words) < 20 or 100 * len(hit) > 30 * len(words)] += 1
    assert want == Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got.collect())
    assert got.where("base_failed AND kept").count() == 0


def test_coverage_decides(spark):
    """Texts of 200 words that pass the base rule and have no long repeat, with a run of so many words twice."""
    runs = [25, 29, 18]
    rows = [(i, " ".join([f"w{k}" for k in range(200 - n)] + [f"w{k}" for k in range(n)])) for i, n in enumerate(runs)]
    got = {r["doc_id"]: r for r in quality_rules.judge(quality_rules.measure(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert [got[i]["n_covered"] for i in range(3)] == [2 * n for n in runs]
    assert not any(r["base_failed"] or r["longest_repeat"] > 100 for r in got.values())
    assert [got[i]["kept"] for i in range(3)] == [False, False, True]


def taught(spark, n=300):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(["the", "quick", "brown", "dog", "runs", "over", "hills"]) for _ in range(rng.randrange(20, 60))]
        bad = i % 3 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["clown", "trash"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad), int(bad)))
    labels += [(None, 1, 1), (1, None, None), (10**9, 1, 0), (2, 7, 7)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_learns(spark, odd):
    docs, labels = taught(spark)
    allowed = F.col("doc_id") % 5 != 0
    model = toxicity.train(docs, labels, "toxic", allowed)
    held = toxicity.score(docs, model).where("doc_id % 5 = 0").collect()
    assert sum((r["score"] >= 0.5) == (r["doc_id"] % 3 == 0) for r in held) >= 0.9 * len(held)
    again = toxicity.train(docs, labels, "toxic", allowed)
    assert np.array_equal(again.emb, model.emb)
    scores = toxicity.score(odd, model)
    assert scores.count() == odd.count() and scores.where("score IS NULL OR score < 0 OR score > 1").count() == 0


def test_quality_learns(spark, odd):
    docs, labels = taught(spark)
    model = quality_classifier.train(docs, labels, "quality", F.col("doc_id") % 4 != 2)
    held = quality_classifier.score(docs, model).where("doc_id % 4 = 2").collect()
    assert sum((r["score"] >= 0.5) == (r["doc_id"] % 3 != 0) for r in held) >= 0.85 * len(held)
    scores = quality_classifier.score(odd, model)
    assert scores.count() == odd.count() and scores.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert quality_classifier.accepted(odd, model, 0.0).count() == odd.count()
    assert quality_classifier.accepted(odd, model, 2.0).count() == 0


def test_classifiers_without_labels(spark):
    docs, labels = taught(spark, 12)
    none = labels.limit(0)
    for module, label in ((quality_classifier, "quality"), (toxicity, "toxic")):
        model = module.train(docs, none, label, F.lit(True))
        assert {r["score"] for r in module.score(docs, model).collect()} == {0.5}
        assert module.score(docs.limit(0), model).count() == 0


def test_subwords_cover_all_ngrams():
    s = quality_classifier.Settings()
    ids, offsets = quality_classifier.subwords([b"abc", b"z"], s)
    # <abc>: the word, three 3-grams, two 4-grams, one 5-gram; <z>: the word and one 3-gram.
    assert np.diff(offsets).tolist() == [7, 2]
    assert ids[0] == zlib.crc32(b"abc") & ((1 << s.bits) - 1)


def test_language_model(spark, odd):
    docs = odd.select("doc_id", "text").union(spark.createDataFrame([(100 + i, "Some words and some OTHER words " * (i + 1)) for i in range(20)], "doc_id long, text string"))
    learnt = ~F.coalesce(F.col("doc_id") % 7 == 2, F.lit(False))
    s = lm_scoring.Settings(head=5)
    got = lm_scoring.score(docs, learnt, queries.tokenizer_path(), settings=s).collect()
    rows = [(r["doc_id"], (r["text"] or "").encode().lower().split()) for r in docs.collect()]
    assert len(got) == len(rows)
    c = Counter(w for i, ws in rows if i is None or i % 7 != 2 for w in [*ws, None])
    n, v = sum(c.values()), len(c)
    want = Counter((i, len(ws) + 1, sum(c[w] > 0 for w in [*ws, None]), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*ws, None]), 6)) for i, ws in rows)
    assert want == Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_lattice_sums_all_segmentations():
    pieces = [b" ", b"a", b"b", b" a", b"ab", b" ab"]
    weights = np.log(np.array([0.1, 0.2, 0.1, 0.2, 0.3, 0.1]))
    lattice = lm_scoring.Lattice(pieces)

    def brute(text):
        return 1.0 if not text else sum(math.exp(w) * brute(text[len(p) :]) for p, w in zip(pieces, weights) if text.startswith(p))

    for word in (b"a", b"ab", b"abab", b"ba", b"aabb"):
        assert math.isclose(math.exp(lattice.log_probabilities([word], weights)[0]), brute(b" " + word), rel_tol=1e-9)
    counts = lattice.expected([b"ab"], np.array([3]), weights)
    # Each segmentation of " ab" by its share.
    ways = {(b" ", b"a", b"b"): 0.002, (b" ", b"ab"): 0.03, (b" a", b"b"): 0.02, (b" ab",): 0.1}
    total = sum(ways.values())
    want = [3 * sum(p * k.count(x) for k, p in ways.items()) / total for x in pieces]
    assert np.allclose(counts, want)


def test_language_model_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm_scoring.score(empty, F.lit(True), queries.tokenizer_path()).count() == 0
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    r = lm_scoring.score(one, F.lit(False), queries.tokenizer_path()).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (1, 0, 0, 0.0)

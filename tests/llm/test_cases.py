"""Defined cases and brute-force versions that go across operators."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from playmill.llm import line_dedup, lm_scoring, mixing, quality_classifier, quality_rules, queries, simhash, sp_codec, suffix_dedup, toxicity

CLASHES = ["label", "row", "number", "hash", "id", "key", "place", "size", "start", "shard", "one", "total", "n_bytes", "_row", "_id", "_key", "_hash", "gone", "spans", "n", "score", "fingerprint", "root", "block", "word"]


@pytest.fixture(scope="module")
def clashing(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(50)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(30 + i)), "en", "ab"[i % 2], 5, *[1000 * i + k for k in range(len(CLASHES))]) for i in range(40)]
    rows += [(40, None, None, None, None, *[None] * len(CLASHES)), (41, "", "en", "a", 0, *[7] * len(CLASHES))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` long" for c in CLASHES))


def test_columns_of_any_name_stay(spark, clashing):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    n = clashing.count()
    extra = lambda df: Counter(tuple(r[c] for c in ("doc_id", *CLASHES)) for r in df.collect())
    own = extra(clashing)
    quality = quality_classifier.train(clashing, labels, "quality", F.lit(True))
    assert quality_classifier.score(clashing, quality).count() == n
    assert extra(quality_classifier.accepted(clashing, quality, 0.0)) == own
    assert toxicity.score(clashing, toxicity.train(clashing, labels, "toxic", F.lit(True))).count() == n
    assert extra(line_dedup.dedup(clashing, length_col="n_chars")) == own
    kept = extra(simhash.keep_one(clashing))
    assert not kept - own
    mixed = extra(mixing.mixed_documents(clashing))
    assert set(mixed) <= set(own) and mixed
    assert mixing.taken_words(mixing.plan(clashing)).count() == n
    for df in (suffix_dedup.dedup(clashing), simhash.near_duplicates(clashing), quality_rules.measure(clashing), sp_codec.encode(clashing, queries.tokenizer_path(), decoded=True), lm_scoring.score(clashing, F.lit(True), queries.tokenizer_path())):
        assert df.count() == n


def test_sample_is_bounded_by_ids_rows_and_bytes(spark, monkeypatch):
    from playmill.llm import training

    docs = spark.createDataFrame([(i % 20, f"text {i}") for i in range(200)] + [(3, "again")] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    sample, sizes = training.labelled_sample(docs, labels, "quality", F.lit(True), 5)
    assert sizes == {0: 10, 1: 10} and sample.count() == 10 == sample.select("doc_id").distinct().count()
    monkeypatch.setattr(training, "MOST_BYTES", 100)

    def features(batches):
        for b in batches:
            sizes = pa.array([40] * b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), sizes, sizes], ["doc_id", "label", "n_bytes", "x"])

    assert training.fitted(sample, features, "x long", lambda t: t.num_rows) == 4
    again, _ = training.labelled_sample(docs, labels, "quality", F.lit(True), 5)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, sample.collect()))


def test_mix_agrees_whatever_the_order_of_rows(clashing):
    taken = lambda df: Counter((r["doc_id"], r["text"]) for r in mixing.mixed_documents(df).collect())
    assert taken(clashing) == taken(clashing.repartition(3).orderBy(F.rand(5)))


def test_slots_are_dealt_over_tasks(spark, monkeypatch):
    """Whatever one source has, no task draws more than so many ranges of slots."""
    monkeypatch.setattr(mixing, "RANGE", 1000)
    for n in (40_000, 160_000):
        sources = spark.createDataFrame([(0, n, n), (1, 50, 50)], "rank int, n_blocks long, n_slots long")
        slots = mixing._slots(sources, mixing.Settings())
        per = slots.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in per) == n + 50 and max(r["count"] for r in per) <= 1000 * 30
        assert slots.groupBy("rank", "shard").agg(F.count("*").alias("n"), (F.max("place") + 1).alias("m")).where("n <> m").count() == 0


def test_document_scores_sum_all_segmentations(spark):
    """Without training rows: words by brute recursion over the vocabulary's first weights, and the end."""
    pieces, weights = lm_scoring.vocabulary(queries.tokenizer_path())
    p = {x: math.exp(w) / 2 for x, w in zip(pieces, weights)}

    def brute(text):
        total = [1.0] + [0.0] * len(text)
        for end in range(1, len(text) + 1):
            total[end] = sum(total[a] * p.get(text[a:end], 0.0) for a in range(end))
        return total[-1]

    texts = ["the cat", "a", "", "Zebra\n zebra x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score(docs, F.lit(False), queries.tokenizer_path()).collect()}
    for i, t in enumerate(texts):
        assert math.isclose(got[i], sum(math.log10(brute(b" " + w)) for w in t.lower().encode().split()) + math.log10(0.5), rel_tol=1e-9)


def test_long_words_are_scored_like_short_ones(monkeypatch):
    pieces, weights = lm_scoring.vocabulary(queries.tokenizer_path())
    lattice = lm_scoring.Lattice(pieces)
    rng = random.Random(2)
    words = ["".join(rng.choice("theinganRST é0") for _ in range(n)).replace(" ", "").encode() for n in (1, 40, 700, 1500)]
    words.append("日本語テキスト".encode() * 40)
    counts = np.array([3.0, 2.0, 1.0, 5.0, 1.0])
    want = lattice.log_probabilities(words, weights), lattice.expected(words, counts, weights)
    monkeypatch.setattr(lm_scoring, "LONG", 0)
    np.testing.assert_allclose(lattice.log_probabilities(words, weights), want[0], rtol=1e-12)
    np.testing.assert_allclose(lattice.expected(words, counts, weights), want[1], rtol=1e-8, atol=1e-12)
    monkeypatch.setattr(lm_scoring, "LONG", 2048)
    long = "".join(rng.choice("abcdefgh+/XYZ019") for _ in range(1_000_000)).encode()
    (got,) = lattice.log_probabilities([long], weights)
    part = lattice.log_probabilities([long[:1000]], weights)[0] / 1000
    assert abs(got / len(long) - part) < 0.1 * abs(part)


def test_language_model_with_training_rows(spark):
    """The whole score again, by recursion over texts: two passes of counting pieces, then the sums."""
    pieces, start = lm_scoring.vocabulary(queries.tokenizer_path())
    texts = ["the cat sat on the mat", "The dog", "", None, "a cat and a dog Zürich", "the end", "unseen words here"]
    learnt = [True, True, True, True, True, False, False]
    docs = spark.createDataFrame([(i, t, k) for i, (t, k) in enumerate(zip(texts, learnt))], "doc_id long, text string, learnt boolean")
    training = Counter(w for t, k in zip(texts, learnt) if k for w in (t or "").lower().encode().split())
    n_docs, s = sum(learnt), lm_scoring.Settings()
    known = {p: i for i, p in enumerate(pieces)}

    def ways(text, p, reverse=False):
        total = [1.0] + [0.0] * len(text)
        for end in range(1, len(text) + 1):
            for a in range(max(0, end - 48), end):
                piece = text[len(text) - end : len(text) - a] if reverse else text[a:end]
                total[end] += total[a] * p[known[piece]] if piece in known else 0.0
        return total

    p = np.exp(start)
    for _ in range(s.passes):
        expected = np.full(len(pieces), s.least)
        for w, n in training.items():
            w = b" " + w
            front, back = ways(w, p), ways(w, p, True)[::-1]
            for a in range(len(w)):
                for b in range(a + 1, len(w) + 1):
                    if w[a:b] in known:
                        expected[known[w[a:b]]] += n * front[a] * p[known[w[a:b]]] * back[b] / front[-1]
        total = expected.sum() + n_docs + s.least
        p, end = expected / total, (n_docs + s.least) / total
    n, v = sum(training.values()) + n_docs, len(training) + 1
    for r in lm_scoring.score(docs, F.col("learnt"), queries.tokenizer_path()).collect():
        words = (texts[r["doc_id"]] or "").lower().encode().split()
        assert math.isclose(r["score"], sum(math.log10(ways(b" " + w, p)[-1]) for w in words) + math.log10(end), rel_tol=1e-9)
        assert math.isclose(r["base_score"], sum(math.log10((training[w] + 1) / (n + v + 1)) for w in words) + math.log10((n_docs + 1) / (n + v + 1)), rel_tol=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words) + 1, sum(training[w] > 0 for w in words) + 1, n)


def test_near_duplicates_without_chance(spark):
    """All hashes, any distance and any signature: the groups are those of brute force."""
    rng = random.Random(12)
    texts = []
    for _ in range(12):
        words = [f"w{rng.randrange(500)}" for _ in range(60)]
        for k in range(3):
            own = list(words)
            for i in rng.sample(range(60), k):
                own[i] = "x"
            texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"] for r in simhash.keep_one(docs, shards=None, radius=64, slack=1.0, signature_size=16).collect()}
    sets = [{tuple(t.split()[i : i + 5]) for i in range(56)} for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                root = [min(root[a], root[b]) if x in (root[a], root[b]) else x for x in root]
    assert got == set(root) and len(got) < len(texts)


def test_verdict_of_quality_rules(spark):
    """kept, n_covered and longest_repeat against brute force over word positions."""
    rng = random.Random(9)
    rows = []
    for i in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(20, 160))]
        for _ in range(rng.randrange(3)):
            n, a, b = rng.randrange(5, 30), rng.randrange(len(words)), rng.randrange(len(words))
            words[b:b] = words[a : a + n]
        rows.append((i, " ".join(words)))
    got = {r["doc_id"]: r for r in quality_rules.judge(quality_rules.measure(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    for i, t in rows:
        w = t.split()
        n = len(w)
        seen = Counter(tuple(w[a : a + 12]) for a in range(n - 11))
        hit = {a + k for a in range(n - 11) if seen[tuple(w[a : a + 12])] > 1 for k in range(12)}
        longest = max((k for k in range(1, n) for c in [Counter(tuple(w[a : a + k]) for a in range(n - k + 1))] if c.most_common(1)[0][1] > 1), default=0)
        assert (got[i]["n_covered"], got[i]["longest_repeat"]) == (len(hit), longest)
        assert got[i]["kept"] == (not got[i]["base_failed"] and len(hit) <= 0.2 * n and longest <= 100)


@pytest.mark.parametrize("name, label", [("op2_quality_classifier", "quality"), ("op9_toxicity", "toxic")])
def test_held_out_rows_of_the_given_tables(spark, name, label):
    sf = "/root/testdata/sf0.01"
    known = spark.read.parquet(f"{sf}/labels.parquet").where(F.col(label).isNotNull()).select("doc_id", label)
    rows = queries.QUERIES[name](spark, sf).where("held_out").join(known, "doc_id").collect()
    y, z, p = (np.array([r[c] for r in rows]) for c in (label, "score", "predicted"))
    share = max(y.mean(), 1 - y.mean())
    wins = (z[y == 1][:, None] > z[y == 0]).mean() + 0.5 * (z[y == 1][:, None] == z[y == 0]).mean()
    assert len(y) > 30 and (p == y).mean() > share and wins > 0.9

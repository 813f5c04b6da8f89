"""The operators over whole corpora: mixing, both dedups, near-dedup, search, and the pipeline."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from playmill.llm import line_dedup, mixing, queries, simhash, suffix_dedup, topk_search
from playmill.llm.components import components

WORDS = [f"w{i}" for i in range(400)]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    """Copies, near copies, shared passages, nulls, empties, a long text, repeated rows and a clashing column."""
    rng = random.Random(3)
    rows = []
    passage = text(rng, 70)
    for i in range(60):
        t = "\n".join(text(rng, rng.randrange(5, 25)) for _ in range(rng.randrange(1, 8)))
        if i % 5 == 0:
            t += "\n" + passage
        rows.append((i, t, rng.choice(["a", "b", None, "ü"])))
    base = rows[7][1]
    rows += [(100 + k, base, "a") for k in range(12)]
    near = text(rng, 120).split()
    for k in range(8):
        words = list(near)
        words[k * 10] = "changed"
        rows.append((200 + k, " ".join(words), "b"))
    rows += [(300, None, "a"), (301, "", None), (302, " \n ", "b"), (None, "a null id " * 8, "a"), (303, text(rng, 20000), "b"), (7, base, rows[7][2]), (304, "x" * 500, "b"), (305, "x" * 200, "b")]
    return spark.createDataFrame([(*r, "en", 0, "rank") for r in rows], "doc_id long, text string, source string, lang string, n_chars long, row string")


def test_mixing(corpus):
    p = mixing.plan(corpus)
    rows = mixing.taken_words(p).collect()
    assert len(rows) == corpus.count()
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    sources = {r["rank"]: r for r in p.sources.collect()}
    assert [sources[k]["source"] for k in sorted(sources)] == ["a", "b", "ü", None]
    taken = Counter()
    for r in rows:
        taken[r["rank"]] += r["taken"]
    for k, s in sources.items():
        assert abs(taken[k] - s["target"]) <= max(0.01 * s["target"], 2 * s["block_words"])
    assert abs(sum(s["target"] for s in sources.values()) - 1.5 * sum(s["source_size"] for s in sources.values())) < 1e-6 or all(s["target"] <= 2 * s["source_size"] for s in sources.values())
    again = mixing.taken_words(mixing.plan(corpus)).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_mixing_targets():
    s = mixing.Settings()
    t = mixing.targets({0: 100, 1: 100, 2: 100}, s)
    assert t[0] == 200 and abs(sum(t.values()) - 450) < 1e-9 and abs(t[2] - 2 * t[1]) < 1e-9
    assert mixing.targets({0: 0, 1: 0}, s) == {0: 0.0, 1: 0.0}


def test_draws_are_whole_and_permutations_are_permutations():
    for total, shards in ((1000, 7), (0, 3), (5, 1)):
        got = mixing.draw(total, shards, (1, 2), 0, total)
        assert sum(c for *_, c in got) == total and [k for k, *_ in got] == sorted({k for k, *_ in got})
        assert [s for _, s, _ in got] == np.cumsum([0, *[c for *_, c in got]])[:-1].tolist()
        for a in range(0, total, 37):  # any range tells the same
            assert mixing.draw(total, shards, (1, 2), a, a + 37) == [x for x in got if x[1] < a + 37 and x[1] + x[2] > a]
    for size in (1, 2, 3, 17, 1000):
        for turn in (0, 1):
            assert sorted(mixing.permuted(np.arange(size), np.full(size, turn), size, (5, 0)).tolist()) == list(range(size))


def test_mixed_documents_hold_what_was_taken(corpus):
    mixed = mixing.mixed_documents(corpus)
    assert mixed.columns == corpus.columns
    got = Counter()
    for r in mixed.collect():
        got[r["doc_id"]] += len(r["text"].encode().split())
    want = Counter()
    for r in mixing.taken_words(mixing.plan(corpus)).collect():
        want[r["doc_id"]] += r["taken"]
    assert abs(sum(got.values()) - sum(want.values())) <= 0.01 * sum(want.values())
    assert all(r["n_chars"] == len(r["text"]) for r in mixed.collect())


def test_mixing_of_nothing(corpus):
    assert mixing.taken_words(mixing.plan(corpus.limit(0))).count() == 0
    assert mixing.mixed_documents(corpus.limit(0)).count() == 0


def brute_spans(rows, length):
    out = Counter()
    for i, t in rows:
        b = (t or "").encode()
        earlier = {o[p : p + length] for j, u in rows if j is not None and (i is None or j < i) for o in [(u or "").encode()] for p in range(len(o) - length + 1)}
        hit = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if b[p : p + length] in earlier:
                hit[p : p + length] = b"\1" * length
        kept = bytes(x for x, h in zip(b, hit) if not h)
        out[i, len(b), sum(h and (k == 0 or not hit[k - 1]) for k, h in enumerate(hit)), hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("length", [50, 12, 138, 200])
def test_suffix_dedup(corpus, length):
    docs = corpus.where("doc_id IS NULL OR doc_id <> 303")
    got = suffix_dedup.dedup(docs, length).collect()
    want = brute_spans([(r["doc_id"], r["text"]) for r in docs.collect()], length)
    assert want == Counter((r["doc_id"], r["n_bytes"], len(r["begins"]), hashlib.sha256(r["kept"]).hexdigest()) for r in got)


def test_maximal_repeats():
    """Groups are maximal, hold every occurrence, and give each string the smallest id that has it."""
    draw, length, anchor = np.random.default_rng(5), 30, suffix_dedup.ANCHOR
    before, width = length - anchor, 2 * length - anchor
    for _ in range(100):
        n = int(draw.integers(1, 14))
        rows = draw.integers(0, 2, (3, width)).astype(np.uint8)[draw.integers(0, 3, n)]
        rows[np.arange(n), draw.integers(0, width, n)] ^= 1
        rows[:, before : before + anchor] = draw.integers(0, 2, n)[:, None]
        first, end = draw.integers(0, before + 1, n), draw.integers(before + anchor, width + 1, n)
        place = np.arange(width)
        rows[(place < first[:, None]) | (place >= end[:, None])] = 0
        low, high = (x := draw.integers(0, 9, n)), x + draw.integers(0, 2, n)
        around = np.concatenate([np.stack([first, end], 1).astype(">u2").view(np.uint8).reshape(n, 4), rows], 1)
        array = suffix_dedup.Array(around, low, high, length)
        got = np.array([least[array.number] for least in suffix_dedup.least_ids(array)])
        strings = [[bytes(r[p : p + length]) if f <= p and p + length <= e else None for r, f, e in zip(rows, first, end)] for p in range(before + 1)]
        for p, own in enumerate(strings):
            for i, x in enumerate(own):
                least = min((low[j] for j in range(n) if own[j] == x), default=None) if x else high[i]
                assert (got[p, i] if got[p, i] < high[i] else None) == (least if least < high[i] else None)
        for back, ahead, group in suffix_dedup.maximal_repeats(array):
            members = [i for i in range(n) if array.number[i] in group]
            reach = {bytes(rows[i, before - back : before + ahead]) for i in members}
            assert len(reach) == 1 and back + ahead >= length
            for a, b, limit in ((before - back - 1, before - back, back == before), (before + ahead, before + ahead + 1, ahead == length)):
                assert limit or len({bytes(rows[i, a:b]) if first[i] <= a and b <= end[i] else None for i in members}) > 1 or not all(first[i] <= a and b <= end[i] for i in members)
            assert all(bytes(rows[i, before - back : before + ahead]) not in reach or first[i] > before - back or end[i] < before + ahead for i in range(n) if i not in members)


def test_suffix_dedup_of_nothing(corpus):
    assert suffix_dedup.dedup(corpus.limit(0)).count() == 0


def brute_lines(rows, window):
    """Rows of distinct (id, text) in order; a window of lines met before goes."""
    order = sorted({(i is None, i or 0, t) for i, t in rows if t is not None})
    seen, out = set(), {}
    for absent, i, t in order:
        lines = t.split("\n")
        real = [k for k, x in enumerate(lines) if x.encode().split()]
        gone = set()
        for a in range(max(1, len(real) - window + 1) if real else 0):
            own = tuple(lines[k] for k in real[a : a + window])
            if own in seen:
                gone.update(real[a : a + window])
            seen.add(own)
        out[None if absent else i, t] = "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone)
    return out


def test_line_dedup(corpus):
    got = line_dedup.measured(corpus).collect()
    assert len(got) == corpus.count()
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    want = brute_lines(rows, 3)
    assert Counter((i, *want.get((i, t), (None, 0))) for i, t in rows) == Counter((r["doc_id"], r["text"], r["n_removed"]) for r in got)
    whole = line_dedup.dedup(corpus, length_col="n_chars")
    assert whole.columns == corpus.columns and whole.count() == corpus.count()
    assert line_dedup.dedup(corpus.limit(0)).count() == 0


def test_line_dedup_runs_no_python(corpus):
    plan = line_dedup.dedup(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_long_lines_are_repeats(spark):
    """The stage's rule against brute force: one or two lines of 50 words count, fewer words don't."""
    import corpus_pipeline

    rng = random.Random(8)
    passage, half, rest, brief = text(rng, 60), text(rng, 30), text(rng, 25), text(rng, 40)
    own = lambda: text(rng, 12)
    texts = ["\n".join(x) for x in (
        [own(), passage, own()], [own(), "", own(), passage], [passage], [own(), half, rest, own()], [own(), half, "", rest], [half, rest], [half, own()],
        [own(), brief], [brief, own()], [own(), passage, own(), passage],
    )]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    seen, want = set(), {}
    for i, t in enumerate(texts):
        lines = t.split("\n")
        real = [k for k, x in enumerate(lines) if x]
        gone = set()
        for at in range(len(real)):
            for n in (1, 2, 3):
                run = real[at : at + n]
                if len(run) == n and (n == 3 or n == len(real) or sum(len(lines[k].split()) for k in run) >= 50):
                    key = tuple(lines[k] for k in run)
                    gone.update(run if key in seen else [])
                    seen.add(key)
        want[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    stage = corpus_pipeline.without_repeated_lines(spark, docs, "").collect()
    assert {r["doc_id"]: r["text"] for r in stage} == want
    assert all(r["n_chars"] == len(r["text"]) for r in stage)
    assert sum(passage in t for t in want.values()) == 1 and want[2] == want[5] == ""
    assert sum(brief in t for t in want.values()) == 2 and sum(half in t for t in want.values()) == 2
    plan = line_dedup.dedup(docs, least_words=50)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_simhash(corpus):
    import xxhash

    got = simhash.near_duplicates(corpus).collect()
    prints = {}
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    for i, t in rows:
        w = (t or "").encode().lower().split()
        grams = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] * bool(w)
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        prints[i, t] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    distinct = sorted(set(prints.values()))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in distinct:
        for b in distinct:
            if (a ^ b).bit_count() <= 3:
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for (i, _), p in prints.items():
        if i is not None:
            least[find(p)] = min(least.get(find(p), i), i)
    want = Counter((i, prints[i, t], least.get(find(prints[i, t]))) for i, t in rows)
    assert want == Counter((r["doc_id"], r["fingerprint"] % 2**64, r["component_id"]) for r in got)
    assert simhash.near_duplicates(corpus.limit(0)).count() == 0


def test_large_shards_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PART", 8)
    rng = random.Random(2)
    base = rng.getrandbits(64)
    values = {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(80)} | {rng.getrandbits(64) for _ in range(40)}
    df = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fingerprint long")
    got = {(r["node"] % 2**64, r["root"]) for r in components(simhash.links(df)).collect()}
    groups = {}
    for n, r in got:
        groups.setdefault(r, {r % 2**64}).add(n)
    left, want = set(values), []
    while left:
        todo, own = [left.pop()], set()
        while todo:
            x = todo.pop()
            own.add(x)
            near = {y for y in left if (x ^ y).bit_count() <= 3}
            left -= near
            todo += near
        if len(own) > 1:
            want.append(frozenset(own))
    assert {frozenset(g) for g in groups.values()} == set(want)


def test_blocks_lose_no_pair():
    rng = random.Random(4)
    for n in (10, 10**8, 10**13):
        tables = simhash.blocks(n, 3)
        for _ in range(200):
            flips = sum(1 << b for b in rng.sample(range(64), 3))
            assert any(all(flips >> s & ((1 << w) - 1) == 0 for s, w in chosen) for chosen in tables)


def test_keep_one(corpus):
    kept = simhash.keep_one(corpus)
    assert kept.columns == corpus.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[7] == 1 and not any(ids[100 + k] for k in range(12))
    assert sum(ids[200 + k] for k in range(8)) == 1
    clean = [i for i in range(60) if i % 5 and i != 7]
    assert all(ids[i] == 1 for i in clean)
    assert sum(ids[i] for i in (300, 301)) == 1
    assert simhash.keep_one(corpus.limit(0)).count() == 0


def test_likeness_is_counted(spark):
    """Pairs of a likeness about 0.8, by shortening or by changed words, against brute force; each pair has its own words."""
    rng = random.Random(6)
    rows, like = [], {}
    for i in range(600):
        own = [f"p{i}w{rng.randrange(10**6)}" for _ in range(104)]
        # 100 shingles, of which 75 to 86 stay; or about 150 with one to five words changed.
        other = own[: rng.randrange(79, 91)]
        if i % 2:
            own += [f"p{i}v{k}" for k in range(rng.randrange(40, 60))]
            other = list(own)
            for k in range(rng.randrange(2, 6)):
                other[10 + 20 * k] = "changed"
        a, b = ({tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in (own, other))
        like[i] = len(a & b) / len(a | b)
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(other))]
    kept = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(2 * i in kept for i in like)
    assert not [x for i, x in like.items() if x < 0.8 and 2 * i + 1 not in kept]
    alike = [i for i, x in like.items() if x >= 0.8]
    assert any(like[i] == 0.8 for i in alike) and sum(2 * i + 1 not in kept for i in alike) >= 0.97 * len(alike)


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 101), (102, 101), (5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 31)} | {101: 100, 102: 100}


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=32).tolist()) for i in range(300)]
    rows += [(400, rows[50][1]), (401, rows[50][1]), (402, None), (403, [None] * 32), (404, [float("nan")] * 32), (405, [float("inf")] * 32), (None, rows[3][1]), (50, rows[50][1]), (50, rows[51][1]), (7, rows[7][1]), (100, rows[3][1]), (450, [1.0, 2.0]), (451, [3.0, -1.0]), (500, [])]
    df = spark.createDataFrame([(i, v, 1, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int")
    got = [tuple(r) for r in topk_search.top_k(topk_search.quantised(df), F.col("vec_id") % 50 == 0).collect()]
    con = duckdb.connect()
    con.register("frame", df.select("vec_id", "embedding").toArrow())
    con.sql("CREATE VIEW embeddings AS SELECT * FROM frame")
    want = [tuple(r) for r in con.sql(topk_search.oracle()).fetchall()]
    assert sorted(got) == sorted((q, r, v, s) for q, r, v, s in want)
    assert topk_search.top_k(topk_search.quantised(df.limit(0)), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_counts_repeated_rows(spark):
    df = spark.createDataFrame([(50, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk_search.top_k(topk_search.quantised(df), F.col("vec_id") % 50 == 0).collect())
    assert [r[1:3] for r in got] == [(1, 1), (2, 1), (3, 2)]


def test_top_k_oracle_query(spark, small):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    got = sorted(tuple(r) for r in queries.op8_topk_search(spark, small).collect())
    assert got == sorted(con.sql(queries.ORACLES["op8_topk_search"]).fetchall())


def test_pipeline(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        docs = corpus_pipeline.written(stage(spark, docs, small), f"test-{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        if k < 3:
            assert docs.count() <= before
    assert docs.where("decoded IS NULL OR size(ids) = 0").count() == 0
    assert corpus_pipeline.run(spark, small).count() == docs.count()

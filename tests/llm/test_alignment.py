"""Cross-tokenizer alignment against a version that goes through all pairs of tokens, and the hash that it counts by."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from playmill.llm import queries, token_alignment
from playmill.llm.token_alignment import PerfectHash, stretches

ODD = ["", None, " ", "  two  spaces ", "a \n b\n\n  c \t\td", "x   y", "word▁mark", "<|endoftext|> <s> </s>", "it's they'LL  'tis", "日本語 テキスト\U0001f600 ế", "\x1c \x1d x", "\x00 \x85   y", "é" * 300, "ab" * 800, "same text", "same text", "1234 5 67\r\n\r\n 8", " lead", "trail ", "\n"]


@pytest.fixture(scope="module")
def paths():
    return queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path()


def brute(texts, paths):
    """Row tuples by the libraries on whole texts, and every pair of tokens compared."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a.encode_special_tokens = True
    alphabet = token_alignment.byte_alphabet()
    each, counts = [], Counter()
    for t in texts:
        links, groups, n = [], [], (0, 0)
        if t:
            ia, ib = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
            ba = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ia]
            bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
            if b"".join(ba) == b"".join(bb) == (" " + t).encode():
                n = len(ia), len(ib)
                ea, eb = np.cumsum(list(map(len, ba))), np.cumsum(list(map(len, bb)))
                sa, sb = ea - [len(x) for x in ba], eb - [len(x) for x in bb]
                links = [(x, y) for x, p, q in zip(ia, sa, ea) for y, r, s in zip(ib, sb, eb) if p < s and r < q]
                last = 0
                for e in sorted({*ea.tolist()} & {*eb.tolist()}):
                    groups.append(",".join(str(x) for x, q in zip(ia, ea) if last < q <= e) + "|" + ",".join(str(x) for x, q in zip(ib, eb) if last < q <= e))
                    last = e
        each.append((n, links, ";".join(groups), len(groups)))
        counts.update(links)
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for (n_a, n_b), links, text, n_groups in each:
        sha = hashlib.sha256(text.encode()).hexdigest() if text else ""
        out.append((n_a, n_b, n_groups, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), sha, text))
    return out


def rows(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, *[r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups")]) for r in df.collect())


@pytest.mark.parametrize("kept, most", [(200_000, 1 << 22), (5, 1500)])
def test_alignment(spark, small, paths, monkeypatch, kept, most):
    """Also where workers start anew after a few stretches, and where the pairs need several rounds."""
    given = [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect() if len(r["text"] or "") < 600][:60]
    texts = [*ODD, *given]
    ids = [None, *range(1, len(texts))]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in zip(ids, texts)], "doc_id long, text string, n_a int, key string")
    if kept < 100:
        monkeypatch.setattr(token_alignment, "SHARD_KEYS", 64)
    got = rows(token_alignment.aligned(docs, *paths, most_pairs=most, spelled=True, kept=kept))
    assert got == sorted((i is None, i or 0, *w) for i, w in zip(ids, brute(texts, paths)))


def test_pairs_are_dealt_into_parts(spark, small, paths, monkeypatch):
    monkeypatch.setattr(token_alignment, "SHARD_KEYS", 64)
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(60)
    some = token_alignment.counted(docs, *paths, most_pairs=3000)
    whole = token_alignment.counted(docs, *paths)
    assert len(some.parts) > 1 == len(whole.parts) and some.best == whole.best
    table = lambda c: {k: n for p in range(len(c.parts)) for k, n in zip(c.part(p).keys().tolist(), c.vector(p).tolist())}
    local = token_alignment.local_counts(docs, *paths).groupBy("key").agg({"n": "sum"}).collect()
    assert table(some) == table(whole) == {k: n for k, n in local}


def test_alignment_of_nothing(spark, paths):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_alignment.aligned(none, *paths).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [tuple(r) for r in token_alignment.aligned(blank, *paths).orderBy("doc_id").collect()] == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2)]


def test_query_digests_whole_groups(spark, small, paths):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op11_token_alignment"](spark, small).collect()}
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert len(got) == len(texts)
    short = [(i, t) for i, t in texts if len(t or "") < 800]
    want = dict(zip([i for i, _ in short], brute([t for _, t in short], paths)))
    assert len(want) > 20
    for i, w in want.items():  # counts are of all texts, the rest of each
        assert (*got[i][:4], got[i][6]) == (*w[:4], w[6]) and got[i][5] >= w[5]


def test_stretches_lose_nothing():
    for t in ODD:
        if t:
            assert " " + t == "".join(" " + u for u in stretches(t))


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 100_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**62, n))
    h = PerfectHash.build(keys)
    assert np.array_equal(np.sort(h.index(keys)), np.arange(len(keys)))
    assert np.array_equal(h.keys[h.index(keys)], keys)
    others = np.setdiff1d(rng.integers(0, 2**62, 1000), keys)
    assert (h.index(others) == -1).all()
    assert sum(words.nbytes for _, words, _ in h.levels) <= 0.6 * len(keys) + 1000

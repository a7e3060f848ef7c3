import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from errata.llm import pitman_yor as py


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def corpus():
    rnd = random.Random(4)
    vocabulary = [f"{a}{b}" for a in ("ba", "lo", "ti", "é") for b in ("ra", "ne", "su", "X")]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = [(i, " ".join(rnd.choices(vocabulary, weights, k=rnd.randrange(1, 60))) + (" rare%d" % i if i % 3 == 0 else "")) for i in range(150)]
    return rows + [(200, None), (201, ""), (202, " \n"), (None, "ba ra"), (5, rows[5][1])]


@pytest.mark.parametrize("block_rows", [10**6, 40])
def test_score(documents, block_rows):
    rows = corpus()
    got = py.score(documents(rows), block_rows=block_rows).collect()
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    counts = Counter(w for d, t in rows if not held(d) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for d, t in rows:
        own = tokens(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        want[(str(d), held(d), len(own), sum(counts[w] > 0 for w in own), n, round(base, 6))] += 1
    assert Counter((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    out = [r for r in got if r.held_out]
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(math.isclose(r.perplexity, 10 ** (-r.score / r.n_tokens), rel_tol=1e-9) for r in got)


def test_tokens_of_a_chunk(monkeypatch):
    """Words and ends in order, whatever is between them and however the texts are cut into blocks."""
    rnd = random.Random(7)
    texts = [None, "", " ", "\n\n", "A", " é\u00a0東\x00 x\x0by ", "\x1c\x1d", "a" * 5000] + ["".join(rnd.choice("aB é\n\t\x85.") for _ in range(rnd.randrange(60))) for _ in range(400)]
    want = [w for t in texts for w in py.words_of(t)]
    for size in (1, 100, 1 << 18):
        monkeypatch.setattr(py, "BLOCK_BYTES", size)
        chunk = py.Chunk()
        sizes = [n for part in py._blocks(texts) for n in chunk.add(part, np.ones(len(part), bool)).tolist()]
        words, codes = chunk.words()
        assert [words[i] for i in codes.tolist()] == want and len(set(words)) == len(words)
        assert sizes == [len(py.words_of(t)) for t in texts]


def test_each_context_sums_to_one(spark):
    """The chances of all known words and of an unknown one, after each of three contexts."""
    rng = np.random.default_rng(5)
    rows = []
    for i, word in enumerate([b"ba", b"bar", b"lo", b"lora", b"\n", b"ti", b"unknown"]):
        counts = rng.integers(0, [900, 40, 3]) * (word != b"unknown") if i else np.array([5000, 700, 0])
        rows.append((bytearray(word), int(counts.sum()), bytearray([0, 1, 7]), bytearray(counts.astype(np.int64).tobytes())))
    totals = spark.createDataFrame(rows, "word binary, total long, classes binary, counts binary")
    known, at = py.learned(totals)
    assert at.customers[[0, 1, 7]].sum() == sum(r[1] for r in rows) and at.customers.sum() == at.customers[[0, 1, 7]].sum()
    one = np.ones(3, "<u4").tobytes()
    asked = [(r[0], i, r[2], bytearray(one), bytearray(np.arange(3 * i, 3 * i + 3, dtype=np.uint16).tobytes())) for i, r in enumerate(rows)]
    words = spark.createDataFrame(asked, "word binary, at long, classes binary, times binary, refs binary")
    got = {r.place: 10**r.score for r in py._sums(words, known, at).collect()}
    for k in range(3):
        assert abs(sum(got[3 * i + k] for i in range(len(rows))) - 1) < 1e-3
    assert got[0] > 3 * got[6]  # the first word is the most frequent in the first context


def test_the_order_of_words_matters(documents):
    rnd = random.Random(1)
    rows = []
    for i in range(300):
        rows.append((i, " ".join(" ".join(rnd.choice([("the", "cat"), ("a", "dog"), ("one", "fish")])) for _ in range(30))))
    held = [i for i in range(1000, 1400) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    rows += [(held[0], "the cat a dog one fish the cat a dog"), (held[1], "cat the dog a fish one cat the dog a")]
    got = {r.doc_id: r for r in py.score(documents(rows)).collect()}
    good, bad = got[held[0]], got[held[1]]
    assert good.base_score == pytest.approx(bad.base_score) and good.score > bad.score + 5


def test_words_of_many_chunks(documents):
    """Chunks of a few tokens add up to the same counts, and texts longer than a chunk stay whole."""
    rows = corpus()
    whole = {(str(r.doc_id), r.n_tokens): (r.n_known, round(r.base_score, 6)) for r in py.score(documents(rows)).collect()}
    split = {(str(r.doc_id), r.n_tokens): (r.n_known, round(r.base_score, 6)) for r in py.score(documents(rows), tokens=25).collect()}
    assert split == whole


def test_empty(documents):
    assert py.score(documents([])).count() == 0
    only_held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    rows = py.score(documents([(i, "a b") for i in only_held])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows] == [(3, 0, 0, 0.0, 0.0)] * 2


def exact_tables(n, new, d):
    """P(tables) by enumerating all seatings of n customers one by one."""
    states = {(1,): 1.0}
    for _ in range(n - 1):
        following = Counter()
        for sizes, p in states.items():
            following[tuple(sorted((*sizes, 1)))] += p * new
            for k in range(len(sizes)):
                grown = list(sizes)
                grown[k] += 1
                following[tuple(sorted(grown))] += p * (sizes[k] - d)
        states = following
    out = Counter()
    for sizes, p in states.items():
        out[len(sizes)] += p
    total = sum(out.values())
    return {t: p / total for t, p in out.items()}


@pytest.mark.parametrize(("n", "new"), [(2, 0.4), (4, 1.5), (6, 0.2)])
def test_tables_against_enumerated_seatings(n, new):
    d, trials = 0.6, 20000
    exact = exact_tables(n, new, d)
    drawn = Counter(py.small_tables(np.full(trials, n), np.full(trials, new), d, np.random.default_rng(1)).tolist())
    assert all(abs(drawn[t] / trials - p) < 0.02 for t, p in exact.items())


@pytest.mark.parametrize("n", [200, 300, 2000])
@pytest.mark.parametrize("d", [0.5, 0.7])
def test_tables_of_many_customers(n, d):
    """The weights' own recursion, against what is drawn: by table, by exact sums, by the saddle point."""
    logs = np.full(n + 2, -np.inf)
    logs[0] = 0.0
    t = np.arange(1, n + 2)
    with np.errstate(divide="ignore"):
        for k in range(n):
            logs[1:] = np.logaddexp(logs[:-1], logs[1:] + np.log(np.maximum(k - d * t, 0)))
            logs[0] = -np.inf
    t = np.arange(1, n + 1)
    for new in (0.001, 0.5, 10, 100, 1000):
        p = logs[1 : n + 1] + t * np.log(new)
        p = np.exp(p - p.max())
        p /= p.sum()
        mean = (p * t).sum()
        spread = math.sqrt((p * t * t).sum() - mean**2)
        drawn = py.small_tables(np.full(4000, n), np.full(4000, new), d, np.random.default_rng(2))
        assert abs(drawn.mean() - mean) < 0.08 * spread + 1e-3 and abs(drawn.std() - spread) < 0.06 * spread + 0.03
        assert drawn.min() >= 1 and drawn.max() <= n


def test_two_restaurants_against_enumeration():
    """Two contexts that share a parent: predictions averaged over many seatings, against the exact
    average over all table counts of all dishes, weighted by their joint probability."""
    counts = {b"xa": 3, b"xb": 1, b"ya": 1, b"yb": 2}
    keys = np.array(sorted(int.from_bytes(k, "big") for k in counts), np.uint64)
    n = np.array([counts[int(k).to_bytes(2, "big")] for k in keys])
    low, root, theta = py.DISCOUNT[1], py.DISCOUNT[0], py.STRENGTH

    def ways(c, d):
        return {t: p for t, p in enumerate(np.exp(py._log_stirling(d)[c, : c + 1])) if t and p > 0}

    def rising(start, step, times):
        return math.prod(start + step * i for i in range(times))

    from itertools import product

    total, predicted = 0.0, np.zeros(4)
    for tables in product(*[ways(c, low).items() for c in n]):
        t = [x for x, _ in tables]
        weight = math.prod(w for _, w in tables)
        for own in ((0, 1), (2, 3)):
            customers, seats = sum(n[i] for i in own), sum(t[i] for i in own)
            weight *= rising(theta + low, low, seats - 1) / rising(theta + 1, 1, customers - 1)
        a, b = t[0] + t[2], t[1] + t[3]
        for (ta, wa), (tb, wb) in product(ways(a, root).items(), ways(b, root).items()):
            joint = weight * wa * wb * rising(theta + root, root, ta + tb - 1) / rising(theta + 1, 1, a + b - 1) * (1 / 256) ** (ta + tb)
            above = [(x - root * y + (theta + root * (ta + tb)) / 256) / (theta + a + b) for x, y in ((a, ta), (b, tb))]
            for i in range(4):
                own = (0, 1) if i < 2 else (2, 3)
                predicted[i] += joint * (n[i] - low * t[i] + (theta + low * sum(t[k] for k in own)) * above[i % 2]) / (theta + sum(n[k] for k in own))
            total += joint
    chain = py.Chain(keys, n, [2, 1], [low, root], lambda k: np.full(len(k), 1 / 256), 3)
    drawn, turns = np.zeros(4), 6000
    for turn in range(turns + 100):
        chain.sweep()
        if turn >= 100:
            drawn += chain.predictions()[0] / turns
    assert np.abs(drawn - predicted / total).max() < 0.02


def test_spelling_sums_to_one():
    words = [b"ba", b"bar", b"barn", b"lo", b"\n"]
    keys, starts = py.stream(words)
    found, counts = np.unique(keys, return_counts=True)
    chain, predictions, weights = py.seat_group(found, counts, np.full((256, 256), 1 / 256), py.SAMPLES)
    kinds = {}
    for i, level in enumerate(chain.levels):
        kinds[5 - i] = (level.keys, np.column_stack([p[i] for p in predictions]).astype(np.float32))
        kinds[i - 5] = (level.contexts, np.column_stack([w[i] for w in weights]).astype(np.float32))
    tables = py.Tables(kinds, np.full((256, 256), 1 / 256), np.ones(1 << 16, bool))
    for context in (b"\n\n\n\n", b"\n\nba", b"zzzz", b"\nbar"):
        every = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
        assert np.abs((10 ** tables.log10(every)).sum(axis=0) - 1).max() < 1e-4
    assert list(starts) == [0, 3, 7, 12, 15]


def test_lookup():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**40, 5000).astype(np.uint64))
    find = py.Lookup(keys)
    assert (find(keys) == np.arange(len(keys))).all()
    assert (find(keys + np.uint64(2**41)) == -1).all()


def test_memory_of_a_chunk():
    """Finding the words of a chunk takes few bytes a token beyond what the chunk holds, and lets that go."""
    import tracemalloc

    rnd = np.random.default_rng(6)
    texts = [" ".join(f"w{i}" for i in rnd.zipf(1.3, 1000) % 5000).encode() for _ in range(300)]
    py.Chunk().add(texts[:20], np.ones(20, bool))  # what is made once for all chunks
    tracemalloc.start()
    try:
        chunk = py.Chunk()
        for at in range(0, len(texts), 20):
            chunk.add(texts[at : at + 20], np.ones(20, bool))
        held = tracemalloc.get_traced_memory()[0]
        tracemalloc.reset_peak()
        words, codes = chunk.words()
        after, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert len(codes) == chunk.tokens and len(set(words)) == len(words)
    assert (peak - held) / chunk.tokens < 40 and after < held / 2


def test_every_word_is_a_context(documents):
    """Of 400 words, all as frequent, each foretells the one after it."""
    rows = [(i, " ".join(f"a{j} b{j}" for j in range(k, k + 40))) for i, k in zip((i for i in range(10**4) if zlib.crc32(str(i).encode()) % 7 != 2), [40 * (i % 10) for i in range(100)])]
    held = [i for i in range(10**5, 10**5 + 9000) if zlib.crc32(str(i).encode()) % 7 == 2][:800]
    rows += [(held[j], f"a{j} b{j}") for j in range(400)] + [(held[400 + j], f"a{j} b{(j + 40) % 400}") for j in range(400)]
    got = {r.doc_id: r.score for r in py.score(documents(rows)).collect()}
    assert all(got[held[j]] > got[held[400 + j]] + 1 for j in range(400))


def test_pairs_seen_once_are_not_answered(spark, documents, monkeypatch):
    """What a chunk knows of its own pairs is not looked up, and no pair has another rest for it."""
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    docs = documents([(i, " ".join(rnd.choices(vocabulary, k=80))) for i in range(120)])
    answered, real = [], py.written

    def counted(df, name, *args, **kwargs):
        out = real(df, name, *args, **kwargs)
        if name == "answers":
            answered.extend(len(r.a) // 4 for r in out.select("a").collect())
        return out

    marked = docs.select("doc_id", "text", (py.crc_mod("doc_id", 7) == 2).alias("held_out"))
    rows = real(py.word_rows(marked, "doc_id", 2000), "words", "zstd").filter("word IS NOT NULL")
    totals = rows.groupBy("word").sum("n").toDF("word", "total")
    scores = []
    for words in (rows, rows.drop("seen")):
        monkeypatch.setattr(py, "written", real)
        known, at = py.learned_from(totals, real(py.pairs_of(rows, "seen", "<u4"), "pairs"))
        monkeypatch.setattr(py, "written", counted)
        answered.append(None)
        scores.append({(r.chunk, r.place): r.score for r in py._sums(words, known, at).collect()})
    cut = [i for i, n in enumerate(answered) if n is None][1]
    assert len({c for c, _ in scores[0]}) > 1
    assert scores[0].keys() == scores[1].keys() and all(math.isclose(scores[0][k], scores[1][k], rel_tol=1e-6) for k in scores[0])
    assert sum(answered[1:cut]) < sum(answered[cut + 1 :]) / 1.5


def test_pairs_are_packed(spark):
    """Each pair is in one bucket, once, with its sum; the pairs of a frequent word are in many; rows are few."""
    rnd = np.random.default_rng(8)
    counts, rows = Counter(), []
    for i in range(40):
        contexts = rnd.choice(10**6, 500, replace=False).astype(np.int64) if i < 5 else rnd.integers(0, 50, 3).astype(np.int64)
        n = rnd.integers(0, 3, len(contexts))
        word = b"the" if i < 5 else b"w%d" % (i % 7)
        for c, k in zip(contexts.tolist(), n.tolist(), strict=True):
            counts[word, c] += k
        rows.append((bytearray(word), bytearray(contexts.tobytes()), bytearray(n.astype(np.int64).tobytes())))
    words = spark.createDataFrame(rows, "word binary, classes binary, counts binary")
    names = {r["h"]: bytes(r["word"]) for r in words.selectExpr("word", "xxhash64(word) AS h").collect()}
    table = py.pairs_of(words, "counts", "<i8").toArrow()
    w, context, n = py._pairs(table)
    got = [((names[a], b), k) for a, b, k in zip(w.tolist(), context.tolist(), n.tolist(), strict=True)]
    assert len(dict(got)) == len(got) and dict(got) == {p: k for p, k in counts.items() if k}
    assert len(set(table["chunk"].to_pylist())) == table.num_rows < len(got) / 20
    of_the = sum(next(k for k, v in names.items() if v == b"the") in py._pairs(b)[0] for i in range(table.num_rows) for b in table.slice(i, 1).to_batches())
    assert of_the == py.Buckets.of(words).contexts > 1

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from errata.llm import simhash as sh
from errata.llm.components import components


def brute_components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint():
    text = "The quick brown fox jumps over the lazy dog"
    w = text.lower().split()
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)]
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    want = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))
    assert sh.fingerprint(sh.hashes(text)) == want
    assert sh.fingerprint(sh.hashes("two words")) == xxhash.xxh64_intdigest("two words", 42)
    assert sh.fingerprint(sh.hashes(None)) == sh.fingerprint(sh.hashes("  \n")) == 0


@pytest.mark.parametrize(("block", "pairs"), [(8192, 4096), (8, 4)])
def test_links_lose_none(spark, monkeypatch, block, pairs):
    monkeypatch.setattr(sh, "PAIRS_AT_ONCE", pairs)
    rnd = random.Random(5)
    values = set()
    for _ in range(25):
        base = rnd.getrandbits(64)
        for _ in range(12):
            v = base
            for b in rnd.sample(range(64), rnd.randrange(7)):
                v ^= 1 << b
            values.add(v)
    values |= {0, 1, 3, 2**64 - 1}
    signed = [(0, int(np.array(v, np.uint64).view(np.int64))) for v in values]
    distinct = spark.createDataFrame(signed, "print int, errata_fp long")
    distinct.write.mode("overwrite").saveAsTable("distinct_fps")
    got = {r.node: r.root for r in components(sh.links(spark.table("distinct_fps"), block=block)).collect()}
    nodes = [x for _, x in signed]
    bits = np.array(nodes, np.int64).view(np.uint64)
    edges = [(a, nodes[j]) for i, a in enumerate(nodes) for j in np.flatnonzero(np.bitwise_count(bits ^ bits[i]) <= 4) if j > i]
    want = brute_components(nodes, edges)
    assert {n: got.get(n, n) for n in nodes} == want


def test_classes(documents):
    long = " ".join(f"word{i}" for i in range(300))
    rows = [(5, long), (3, long), (9, long + " end"), (7, "other text entirely here now"), (1, None), (2, ""), (8, " "), (None, "other text entirely here now"), (3, long)]
    got = sorted((str(r.doc_id), r.component_id) for r in sh.classes(documents(rows)).collect())
    assert got == sorted([("5", 3), ("3", 3), ("9", 3), ("7", 7), ("1", 1), ("2", 1), ("8", 1), ("None", 7), ("3", 3)])
    assert sh.classes(documents([])).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def jaccard(x, y):
    a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)} for w in (x.split(), y.split()))
    return len(a & b) / len(a | b)


def test_near_copies(documents):
    rnd = random.Random(2)
    rows, wanted = [], {}
    for group in range(12):
        base = [f"w{rnd.randrange(4000)}" for _ in range(rnd.choice([60, 150, 400]))]
        for copy in range(4):
            own = list(base)
            for _ in range(copy * len(base) // 150):
                own[rnd.randrange(len(own))] = f"n{rnd.random()}"
            if jaccard(" ".join(base), " ".join(own)) >= 0.8:
                rows.append((10 * group + copy, " ".join(own)))
                wanted[10 * group + copy] = 10 * group
    rows += [(500, None), (501, ""), (502, "a b"), (503, "a b"), (504, "a c"), (502, "a b")]
    wanted |= {500: 500, 501: 500, 502: 502, 503: 502, 504: 504}
    docs = documents(rows)
    got = {r.doc_id: r.component_id for r in sh.near_copies(docs).collect()}
    assert got == wanted
    kept = sh.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({v for v in wanted.values()})
    assert sh.deduplicate(documents([])).count() == 0


def test_dissimilar_stay(documents):
    base = [f"w{i}" for i in range(100)]
    other = [w if i % 6 else f"n{i}" for i, w in enumerate(base)]
    assert sh.deduplicate(documents([(1, " ".join(base)), (2, " ".join(other))])).count() == 2
    assert sh.near_copies(documents([(None, "x y z"), (None, "x y z")])).filter(F.col("component_id").isNull()).count() == 2


def expected(rows):
    edges = [(a, b) for a, x in rows for b, y in rows if a < b and jaccard(x, y) >= 0.8]
    return brute_components([i for i, _ in rows], edges)


def test_near_copies_of_large_families(documents):
    """Of many texts that are near the family's first, and of each other, no similar pair is lost."""
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(0, 120, 2):
        one = list(base)
        rnd.shuffle(one)
        one[rnd.randrange(150)] = f"n{i}"
        two = list(one)
        two[rnd.randrange(150)] = f"m{i}"
        rows += [(i, " ".join(one)), (i + 1, " ".join(two))]
    want = expected(rows)
    assert len(set(want.values())) == 60
    got = {r.doc_id: r.component_id for r in sh.near_copies(documents(rows)).collect()}
    assert got == want


def test_near_copies_of_equal_word_sets(documents):
    """Texts that have the same words in other orders hide no similar pair among them."""
    rnd = random.Random(12)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(0, 60, 2):
        one = list(base)
        rnd.shuffle(one)
        two = list(one)
        two[3], two[4] = two[4], two[3]
        rows += [(i, " ".join(one)), (i + 1, " ".join(two))]
    want = expected(rows)
    assert len(set(want.values())) == 30
    got = {r.doc_id: r.component_id for r in sh.near_copies(documents(rows)).collect()}
    assert got == want


def test_near_copies_of_blocks(documents):
    """Copies that are cut short, added to or have a block inserted are found as scattered edits are."""
    rnd = random.Random(13)
    rows = []
    for i in range(0, 80, 2):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(rnd.choice([100, 300]))]
        more = [f"b{rnd.random()}" for _ in range(len(base) // 5 - 2)]
        at = len(base) // 2
        own = {0: base + more, 1: base[: len(base) - len(more) + 2], 2: base[:at] + more[:-4] + base[at:], 3: more + base}[i // 2 % 4]
        rows += [(i, " ".join(base)), (i + 1, " ".join(own))]
    want = expected(rows)
    assert len(set(want.values())) == 40
    got = {r.doc_id: r.component_id for r in sh.near_copies(documents(rows)).collect()}
    assert got == want


def test_near_copies_whatever_the_blocks(documents, monkeypatch):
    """A template with many edits, a chain of copies, and texts that share boilerplate: the groups are
    those of exact similarity, whatever is compared at once."""
    rnd = random.Random(14)
    template = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        own = list(template)
        for at in rnd.sample(range(120), rnd.randrange(1, 9)):
            own[at] = f"e{rnd.randrange(40)}"
        rows.append((i, " ".join(own)))
    chain = [f"c{i}" for i in range(100)]
    for i in range(90, 110):
        rows.append((i, " ".join(chain)))
        chain[5 * (i - 90)] = f"d{i}"
    rows += [(i, " ".join(template[:80] + [f"o{i}-{k}" for k in range(16)])) for i in range(110, 140)]
    want = expected(rows)
    for block, pairs in ((8192, 256), (8, 4)):
        monkeypatch.setattr(sh, "PAIRS_AT_ONCE", pairs)
        got = {r.doc_id: r.component_id for r in sh.near_copies(documents(rows), block=block).collect()}
        assert got == want


def test_near_copies_link_what_is_linked_once(documents, monkeypatch):
    """Links of an earlier step are not walked through again: a later step hands over none but its own."""
    rnd = random.Random(15)
    rows = []
    for i in range(0, 40, 4):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(300)]
        for k in range(4):
            rows.append((i + k, " ".join([*base[:-1], f"n{k}"])))
    handed = []

    def counted(edges):
        edges = sh.written(edges, "handed")
        handed.append(edges.filter("a != b").count())
        return components(edges)

    monkeypatch.setattr(sh, "components", counted)
    got = {r.doc_id: r.component_id for r in sh.near_copies(documents(rows)).collect()}
    assert got == expected(rows)
    assert handed[0] >= 30
    assert sum(handed) - handed[0] <= 30 and handed[-1] == 0


def test_joined_roots(spark):
    """Links between contents that are linked with others already, and with new ones."""
    rows = [(2, 1), (3, 1), (5, 4), (6, 4), (9, 8)]
    roots = spark.createDataFrame(rows, "content long, root long")
    edges = [(3, 6), (5, 2), (7, 9), (10, 11), (2, 3)]
    got = [(r.content, r.root) for r in sh._joined(roots, spark.createDataFrame(edges, "a long, b long")).collect()]
    want = brute_components(range(1, 12), [*rows, *edges])
    assert len(dict(got)) == len(got)
    assert {n: dict(got).get(n, n) for n in range(1, 12)} == want
    same = sh._joined(roots, spark.createDataFrame([(2, 3), (6, 5)], "a long, b long"))
    assert sorted(map(tuple, same.collect())) == rows

import numpy as np
import pytest

from errata.llm import ann


def brute(rows, k, every):
    x = {i: np.array(v) for i, v in rows}
    out = {}
    for q in (i for i in x if i % every == 0):
        scored = sorted((-float((x[q] * v).sum()), i) for i, v in x.items() if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 1.0, 2) for i, v in rows], "vec_id long, embedding array<float>, label int, score double, rank int")


def random_rows(n, d, seed, scale=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * (rng.uniform(0.5, 2, size=(n, 1)) if scale else 1)
    return [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize(("group", "block"), [(16384, 4096), (40, 4)])
def test_exact_with_full_reach(spark, group, block):
    rows = random_rows(300, 8, 1)
    rows += [(1000 + i, rows[20][1]) for i in range(60)] + [(2000 + i, rows[40][1]) for i in range(30)]
    got = by_query(ann.neighbours(table(spark, rows), recall=1.0, k=10, group_rows=group, query_block=block))
    assert got == brute(rows, 10, 20)


def test_recall_and_order(spark, monkeypatch):
    rows = random_rows(3000, 16, 2)
    monkeypatch.setattr(ann, "BUCKET_ROWS", 8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keys meet by their hashes alone
    got, want = by_query(ann.neighbours(table(spark, rows), group_rows=500)), brute(rows, 20, 20)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(got) == set(want)
    found = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(found) >= 0.9
    x = dict(rows)
    for q, hits in got.items():
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0]))
        assert all(s == float((np.array(x[q]) * np.array(x[v])).sum()) for v, s in hits)


def test_what_takes_no_part(spark):
    good = random_rows(6, 3, 3)
    bad = [(20, None), (40, [0.0, 0.0, 0.0]), (60, [1.0, None, 2.0]), (80, [float("nan"), 1.0, 1.0]), (100, [float("inf"), 0.0, 0.0]), (120, [1.0, 2.0]), (140, []), (None, [1.0, 1.0, 1.0])]
    got = by_query(ann.neighbours(table(spark, good + bad + [good[0]]), recall=1.0))
    assert got == brute(good, 20, 20)
    assert ann.neighbours(table(spark, [])).count() == 0
    assert ann.neighbours(table(spark, bad)).count() == 0
    assert ann.neighbours(table(spark, [(0, [1.0, 2.0])])).count() == 0
    assert ann.neighbours(table(spark, [(1, [1.0, 2.0]), (3, [1.0, 1.0])])).count() == 0


def test_probes_are_visited_in_order_of_success():
    """All buckets within reach, against every bucket there is, in the order of their distances."""
    index = ann.Index(1.0, np.zeros((1, 3, 3)), np.zeros((1, 3)), np.ones(1), reach=4.0)
    asked = np.array([[0.9, 0.5, -3.2], [-9.0, 7.0, 0.0]])
    query, bucket = index.probes(asked)
    every = np.stack(np.meshgrid(*[np.arange(ann.SLOTS)] * 3, indexing="ij"), -1).reshape(-1, 3)
    for q in (0, 1):
        cost = index.gaps(asked[q], every).sum(1)
        order = np.lexsort((index.buckets(every), cost))
        assert bucket[query == q].tolist() == index.buckets(every)[order][cost[order] <= 4.0].tolist()
    assert index.gaps(np.array([0.9]), np.array([ann.SLOTS // 2 + 1]))[0] == (0 if ann.SLOTS == 2 else pytest.approx(0.01))
    assert index.gaps(np.array([-9.0]), np.array([0]))[0] == 0


def test_hot_bucket_in_pieces(spark):
    """A third of all rows in one small ball, in one bucket: pieces and blocks lose none of them."""
    rng = np.random.default_rng(9)
    near = [(i, [float(np.float32(v)) for v in [1, 0, 0, 0] + rng.normal(size=4) * 1e-3]) for i in range(300, 450)]
    rows = random_rows(300, 4, 4) + near
    got = by_query(ann.neighbours(table(spark, rows), recall=1.0, group_rows=30, query_block=3))
    assert got == brute(rows, 20, 20)

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from errata.llm import suffixes as sx


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, least):
    holders = defaultdict(set)
    for n, (_, text) in enumerate(rows):
        w = split(text)
        for i in range(len(w) - least + 1):
            holders[tuple(w[i : i + least])].add(n)
    out = []
    for doc, text in rows:
        w, spans = split(text), []
        for i in range(len(w) - least + 1):
            if len(holders[tuple(w[i : i + least])]) > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + least
                else:
                    spans.append([i, i + least])
        if spans:
            out.append((str(doc), len(w), ",".join(f"{a}:{b}" for a, b in spans)))
    return sorted(out)


@pytest.mark.parametrize(("least", "shingle"), [(10, 3), (10, 10), (6, 2)])
def test_brute_force(documents, least, shingle):
    rnd = random.Random(least)
    passages = [[f"p{rnd.randrange(50)}" for _ in range(rnd.randrange(5, 30))] for _ in range(6)]
    rows = []
    for i in range(80):
        words = [f"w{rnd.randrange(30)}" for _ in range(rnd.randrange(40))]
        for p in rnd.sample(passages, rnd.randrange(3)):
            at = rnd.randrange(len(words) + 1)
            words[at:at] = p[: rnd.randrange(4, len(p) + 1)]
        if i % 9 == 0:
            words = words * 2
        rows.append((i, " ".join(words).upper() if i % 4 == 0 else "\n".join(words)))
    rows += [(90, None), (91, ""), (92, rows[0][1]), (None, rows[0][1]), (3, rows[3][1]), (93, "a " * 200), (94, "A " * 150)]
    got = sorted((str(r.doc_id), r.n_words, r.spans) for r in sx.report(documents(rows), least=least, shingle=shingle).collect())
    assert got == brute(rows, least)


def test_only_other_documents_count(documents):
    text = " ".join(f"w{i}" for i in range(60))
    docs = documents([(1, text + " x " + text), (2, "other")])
    assert sx.report(docs).count() == 0
    assert [len(r.spans) for r in sx.passages(docs).collect()] == [0, 0]
    assert sx.report(documents([])).count() == 0


def test_later_keeps_one_copy(documents):
    text = " ".join(f"w{i}" for i in range(60))
    docs = documents([(1, "a " + text), (2, text + " b"), (3, "c c")]).coalesce(1)
    later = {r.doc_id: [tuple(s) for s in r.later] for r in sx.passages(docs, later=True).collect()}
    assert later == {1: [], 2: [(0, 60)], 3: []}
    assert sx.without(text + " b", later[2]) == " b"
    assert {r.doc_id: r.text for r in sx.deduplicated(docs).collect()} == {1: "a " + text, 2: " b", 3: "c c"}


def test_later_against_brute_force(documents):
    rnd = random.Random(8)
    passages = [[f"p{rnd.randrange(40)}" for _ in range(25)] for _ in range(4)]
    rows = []
    for i in range(60):
        words = [f"w{rnd.randrange(400)}" for _ in range(rnd.randrange(20))]
        for p in rnd.sample(passages, rnd.randrange(3)):
            at, cut = rnd.randrange(len(words) + 1), rnd.randrange(12)
            words[at:at] = p[cut:]
        rows.append((i, " ".join(words)))
    got = {r.doc_id: [tuple(s) for s in r.later] for r in sx.passages(documents(rows).coalesce(1), least=8, shingle=3, later=True).collect()}
    seen = {}
    for i, text in rows:
        w = split(text)
        for k in range(len(w) - 7):
            seen.setdefault(tuple(w[k : k + 8]), i)
    for i, text in rows:
        w, spans = split(text), []
        for k in range(len(w) - 7):
            if seen[tuple(w[k : k + 8])] < i:
                if spans and k <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], k + 8)
                else:
                    spans.append((k, k + 8))
        assert got[i] == spans


def test_maximal_lengths(documents):
    """A passage longer than the window, among other words, comes back at its full length, also where
    it agrees with one document to the left and with another to the right."""
    rnd = random.Random(3)
    shared = [f"s{i}" for i in range(700)]
    own = lambda n: [f"o{rnd.random()}" for _ in range(n)]
    rows = [(1, " ".join(own(30) + shared + own(9))), (2, " ".join(own(11) + shared + own(70))), (3, " ".join(own(5) + shared[100:149] + own(5)))]
    rows += [(4, " ".join(own(60) + shared[200:300] + own(3))), (5, " ".join(shared[:30] + own(80) + shared[650:]))]
    got = {r.doc_id: r.spans for r in sx.report(documents(rows)).collect()}
    assert got == {1: "30:730", 2: "11:711", 4: "60:160", 5: "110:160"}


def test_rolling_and_minimisers():
    values = np.random.default_rng(1).integers(0, 2**63, 100).astype(np.uint64)
    for length in (1, 2, 3, 7, 12, 50):
        full = sx.rolling(values, length)
        assert len(full) == 101 - length
        assert all(sx.rolling(values[i : i + length], length)[0] == full[i] for i in range(0, len(full), 7))
    for window in (1, 2, 5, 39):
        got = sx.minimisers(values, window)
        assert got.tolist() == [i + int(np.argmin(values[i : i + window])) for i in range(101 - window)]

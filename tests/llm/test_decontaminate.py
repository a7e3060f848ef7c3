import random
import re

import pytest

from errata.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window):
    own, hit, found = words(text), set(), set()
    for item, other in items:
        other = words(other)
        n = min(window, len(other))
        wins = {tuple(other[i : i + n]) for i in range(len(other) - n + 1)} if n else set()
        for i in range(len(own) - n + 1):
            if n and tuple(own[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                found.add(str(item))
    return len(own), len(hit), sorted(found)


@pytest.fixture
def tables(spark, documents):
    rnd = random.Random(3)
    vocabulary = "a b c d É f".split()
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(1, "a B c d"), (2, "É f"), (3, text(12)), (4, text(9)), (5, ""), (6, None), (10, text(12)), (7, "d")]
    rows = [(i, text(rnd.randrange(40))) for i in range(60)] + [(70, None), (71, ""), (None, text(30)), (3, text(20)), (72, "X-" + items[2][1].upper().replace("É", "É") + "!")]
    return documents(rows), rows, spark.createDataFrame(items, "item_id long, text string"), items


@pytest.mark.parametrize("block", [10_000, 14])
def test_brute_force(tables, block):
    docs, rows, benchmark, items = tables
    got = sorted((str(r.doc_id), r.n_words, sum(r.spans[1::2]) - sum(r.spans[::2]), list(r.items)) for r in dc.scan_documents(docs, benchmark, window=5, block_words=block).collect())
    assert got == sorted((str(d), *brute(t, items, 5)) for d, t in rows)


def test_empty(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    row = dc.contamination(documents([(1, "a b")]), none).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)
    assert dc.contamination(documents([]), none).count() == 0


@pytest.mark.parametrize("block", [10_000, 16])
def test_removal(spark, documents, block):
    benchmark = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(12))), (2, " ".join(f"v{i}" for i in range(12)))], "item_id long, text string")
    passage = " ".join(f"W{i}" for i in range(12))
    docs = documents([(1, f"Some Clean Words BEFORE it, {passage}. AND some more clean words after that, so many that it stays"), (2, passage), (3, "clean"), (4, None), (5, "")])
    out = {r.doc_id: r for r in dc.decontaminate(docs, benchmark, block_words=block).collect()}
    assert set(out) == {1, 3, 4, 5}
    assert out[1].text == "Some Clean Words BEFORE it, . AND some more clean words after that, so many that it stays"
    assert out[1].n_chars == len(out[1].text)
    assert (out[3].text, out[4].text, out[4].n_chars, out[1].key) == ("clean", None, None, "k")
    assert dc.decontaminate(docs, benchmark, block_words=block).columns == docs.columns


def test_very_long_text_and_many_blocks(spark, documents, monkeypatch):
    """All blocks in turn over chunks of texts: hits of several blocks are merged where the text is."""
    monkeypatch.setattr(dc, "CHUNK", 1)
    items = [(i, " ".join(f"w{k}" for k in range(8 * i, 8 * i + 20))) for i in range(30)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    long = "so it goes " * 60_000 + " ".join(f"W{k}" for k in range(300)) + " and on " * 60_000
    rows = [(1, long), (2, "w8 w9"), (3, None)]
    got = {r.doc_id: (r.n_words, r.spans, len(r.items)) for r in dc.scan_documents(documents(rows), benchmark, block_words=45).collect()}
    assert got == {1: (300_300, [180_000, 180_252], 30), 2: (2, [], 0), 3: (0, [], 0)}

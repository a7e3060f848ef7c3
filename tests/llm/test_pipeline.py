"""The pipeline over small tables, against what each stage is to do, done plainly."""

import random
import re
import zlib

import pytest

import corpus_pipeline
from errata.llm import toxicity
from errata.llm.common import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture
def folder(spark, tmp_path):
    rnd = random.Random(6)
    vocabulary = [f"word{i}" for i in range(900)]
    text = lambda n: ". ".join(" ".join(rnd.choices(vocabulary, k=6)) for _ in range(n))
    items = [" ".join(rnd.choices(vocabulary, k=30)) for _ in range(5)]
    rows, labels = [], []
    for i in range(240):
        body = text(rnd.randrange(6, 25))
        if i % 6 == 0:
            body += ". what a vileword you are"
        if i % 10 == 3:
            body += ". " + items[i % 5].upper()
        if i % 11 == 4:
            body += ". password=hunter%d22" % i
        rows.append((i, body))
        labels.append((i, 1, int(i % 6 == 0)))
    for i in range(240, 280):
        words = rows[i - 239][1].split(" ")
        if i % 2:
            words[rnd.randrange(len(words))] = "edited"
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int((i - 239) % 6 == 0)))
    rows += [(300, None), (301, ""), (302, items[0])]
    path = f"file://{tmp_path}"
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, dict(rows), items


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def test_stages(spark, folder):
    path, text, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    outs = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, path), name)
        outs[name] = docs.collect()
        if name != "packing":
            assert docs.columns == COLUMNS
            assert all(r.n_chars == len(r.text or "") for r in outs[name])

    kept = {r.doc_id for r in outs["toxicity"]}
    assert kept == {d for d, t in text.items() if "vileword" not in (t or "")}

    parent = {d: d for d in kept}
    for a in kept:
        for b in kept:
            x, y = shingles(text[a]), shingles(text[b])
            if a < b and len(x & y) >= 0.8 * len(x | y):
                parent[b] = min(parent[b], parent[a])
    kept = {d for d in kept if parent[d] == d}
    assert {r.doc_id for r in outs["simhash"]} == kept

    cleaned = {r.doc_id: r.text for r in outs["decontamination"]}
    assert set(cleaned) == kept - {302}
    for d, t in cleaned.items():
        assert not any(item in (t or "").lower() for item in items)
        if not any(item.upper() in (text[d] or "") for item in items):
            assert t == text[d]

    redacted = {r.doc_id: r.text for r in outs["secrets"]}
    assert redacted == {d: None if t is None else re.sub(r"password=hunter\d+", "[SECRET]", t) for d, t in cleaned.items()}
    assert {r.doc_id for r in outs["packing"]} == set(redacted)


def test_run(spark, folder):
    path, text, _ = folder
    rows = corpus_pipeline.run(spark, path).collect()
    assert rows and {r.doc_id for r in rows} <= set(text)
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_labels_of_held_out_rows_are_not_read(spark, folder):
    path, _, _ = folder
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet").collect()
    flipped = [(r.doc_id, r.quality, 1 - r.toxic if zlib.crc32(str(r.doc_id).encode()) % 3 == 1 else r.toxic) for r in labels]
    one = toxicity.fit(docs, spark.createDataFrame(labels))
    two = toxicity.fit(docs, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int"))
    assert one.weights == two.weights and one.bias == two.bias


def test_nulls_clashing_columns_and_long_texts(spark, folder, tmp_path):
    """Every stage keeps columns it does not know, whatever their names, and takes nulls in any column."""
    path, text, items = folder
    from pyspark.sql import functions as F

    base = spark.read.parquet(f"{path}/documents.parquet").filter("doc_id < 60")
    odd = [(None, "lonely words that nobody else has written here", None, None, None), (500, None, None, "s", 0), (500, None, None, "s", 0), (501, "", "en", None, None)]
    odd += [(502, "quite long and calm. " * 30_000 + "token=abcdef99 " + items[1], "en", "s", 1), (503, "é" * 200_000, "en", "s", 2)]
    odd += [(504, "twice the same row of words in this table", "en", "s", 3)] * 2
    docs = base.unionByName(spark.createDataFrame(odd, base.schema))
    clashing = ("key", "content", "n", "root", "part", "blob", "path", "score", "words", "size", "errata", "least", "Text2", "label", "toxic", "item_id")
    docs = docs.withColumns({c: F.lit(None).cast("string") if i % 2 else F.lit(i) for i, c in enumerate(clashing)})
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, path), name)
        if name != "packing":
            assert docs.columns == columns
    rows = docs.collect()
    assert {None, 500, 501, 502, 503, 504} & {r.doc_id for r in rows} >= {None, 502, 503, 504}
    assert len({(r.doc_id, r.piece, r.start) for r in rows}) == len(rows)


def test_empty_tables(spark, folder, tmp_path):
    path, _, _ = folder
    empty = f"file://{tmp_path}/none"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from errata.llm import pack

tokenizers = pytest.importorskip("tokenizers")


def ids_of(text):
    return tokenizers.Tokenizer.from_file(pack.tokenizer_path()).encode(text or "", add_special_tokens=False).ids + [0]


def check(packed, rows, capacity):
    bins = {}
    for r in packed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    got = sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in packed)
    want = []
    for doc, text in rows:
        ids = ids_of(text)
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            want.append((doc is None, doc or 0, piece, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    assert got == sorted(want)
    return len(bins)


def test_pack(documents):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(["alpha", "Beta,", "été", "x1"]) for _ in range(rnd.randrange(60)))) for i in range(80)]
    rows += [(100, None), (101, ""), (None, "no id"), (5, rows[5][1]), (102, "word " * 5000), (103, "naïve 東京 <|endoftext|> it's İX \x85 　")]
    n = check(pack.pack(documents(rows), capacity=64).collect(), rows, 64)
    total = sum(len(ids_of(t)) for _, t in rows)
    assert n <= -(-total // 64) + 2


def test_empty_and_sequences(documents):
    assert pack.pack(documents([])).count() == 0
    rows = [(1, "a b c"), (2, "d e")]
    got = pack.sequences(pack.pack(documents(rows), capacity=16, with_ids=True)).collect()
    assert sorted(sum((list(r.ids) for r in got), [])) == sorted(ids_of("a b c") + ids_of("d e"))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 6), min_size=1, max_size=6))
def test_fullest_is_optimal(counts):
    capacity, ceiling = 12, max(counts)
    chosen = pack.fullest(counts, capacity, ceiling)
    for n in set(chosen):
        assert chosen.count(n) <= counts[n]
    sums = {0}
    left = dict(counts)
    left[ceiling] -= 1
    for n, c in left.items():
        for _ in range(c):
            sums |= {s + n for s in sums if s + n <= capacity - ceiling}
    assert sum(chosen) == ceiling + max(sums)


def test_encoder_cache(monkeypatch):
    monkeypatch.setattr(pack, "CACHE_WORDS", 3)
    encode = pack.Encoder(pack.tokenizer_path())
    for text in ("one two three four five", "東 京 大 阪 <|startoftext|>", "one, 'two' don't A_b 12"):
        assert np.frombuffer(encode(text), "<u4").tolist() == ids_of(text)[:-1]

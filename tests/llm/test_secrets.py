import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from errata.llm import secrets

PATTERNS = {r.kind: re.compile(r.pattern) for r in secrets.RULES}


def brute(text):
    found = []
    for number, rule in enumerate(secrets.RULES):
        found += [(m.start(), number, m.end()) for m in PATTERNS[rule.kind].finditer(text or "") if len(m[rule.group]) >= rule.least]
    return sorted(found)


def shown(spans, kinds):
    return ",".join(f"{secrets.RULES[k].kind}:{a}:{b}" for a, k, b in spans if secrets.RULES[k].kind in kinds)


CASES = [
    None, "", "x", "password=hunter22", "password=abc", "password=token:abcdefgh", "API_KEY: 'abc123def' é東 secret = zzzzzz1", "token:=abcde",
    "AKIA" + "A1" * 8, "AKIA" + "A" * 15, "AKIAAKIA" + "B" * 20, "é" * 3 + "deadbeef" * 3, "deadbee" * 3, "f" * 24 + " " + "0" * 30,
    "secret=" + "a0" * 15, "ghp_" + "aB3" * 12, "-----BEGIN RSA PRIVATE KEY-----", "passwd=" + "x" * 20000 + " token: 'abcdef'", "Token=AKIA" + "Z" * 16, 'apikey"="abcdef"',
]


def test_brute_force(documents):
    rows = list(enumerate(CASES)) + [(None, "password=hunter22"), (3, "password=hunter22"), (3, "password=other222")]
    known, ledger = secrets.update(documents(rows))
    got = sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in secrets.report(known, ledger).collect())
    base = {r.kind for r in secrets.BASE}
    want = []
    for doc, text in rows:
        spans = brute(text)
        counts = [sum(secrets.RULES[k].kind == kind for _, k, _ in spans) for kind in ("assign", "access", "hex")]
        want.append((str(doc), *counts, hashlib.sha256(shown(spans, base).encode()).hexdigest(), shown(spans, PATTERNS)))
    assert got == sorted(want)


def test_ledger_is_incremental(documents):
    old = documents([(1, "password=hunter22"), (2, "x")])
    known, ledger = secrets.update(old, rules=secrets.BASE)
    assert ledger.count() == 2
    newer = documents([(1, "password=hunter22"), (1, "token=abcdefg"), (3, "x"), (4, None)])
    known, more = secrets.update(newer, ledger, rules=secrets.BASE)
    assert more.count() == 4
    before = {bytes(r.blob): r.scanned for r in ledger.collect()}
    assert {b: s for b, s in ((bytes(r.blob), r.scanned) for r in more.collect()) if b in before} == before
    _, all_rules = secrets.update(newer, more)
    assert {len(r.scanned) for r in all_rules.collect()} == {len(secrets.RULES)}
    assert secrets.report(known, more, secrets.BASE).count() == 4
    _, same = secrets.update(documents([]), more, rules=secrets.BASE)
    assert same.count() == 4


def test_redaction(documents):
    docs = documents([(1, "é password=hunter22 and secret: deadbeefdeadbeefdeadbeefdead."), (2, "clean"), (3, None), (4, ""), (5, "password=hunter22")])
    out = {r.doc_id: r for r in secrets.redact(docs).collect()}
    assert out[1].text == "é [SECRET] and [SECRET]"
    assert out[1].n_chars == len(out[1].text)
    assert (out[2].text, out[3].text, out[3].n_chars, out[4].text, out[5].text) == ("clean", None, None, "", "[SECRET]")
    assert secrets.redact(docs).columns == docs.columns


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="akeypi_pswordtn:='\" 0fAKI", max_size=60))
def test_run_patterns_equal_filters(text):
    for pattern, plain, least in ((r"AKIA[A-Z0-9]{16,}", r"AKIA[A-Z0-9]+", 20), (r"[0-9a-f]{24,}", r"[0-9a-f]+", 24)):
        longer = text * 3
        assert [m.span() for m in re.finditer(pattern, longer)] == [m.span() for m in re.finditer(plain, longer) if len(m[0]) >= least]


def test_many_matches_in_a_text(documents):
    text = " ".join(f"é token=abcdef{i:04} {'f' * 24}" for i in range(1500))
    docs = documents([(1, text), (1, text), (None, text)])
    (row, *_), spans = secrets.report(*secrets.update(docs)).collect(), brute(text)
    assert (row.n_assign, row.n_hex, row.spans) == (1500, 1500, shown(spans, PATTERNS))
    out = {r.text for r in secrets.redact(docs).collect()}
    assert out == {" ".join(["é [SECRET] [SECRET]"] * 1500)}


def test_versions_and_a_kept_ledger(spark, documents, tmp_path):
    """Each version of a path keeps its own row; a later run scans what no run before has."""
    folder = f"file://{tmp_path}/ledger"
    first = documents([(1, "password=hunter22"), (1, "x"), (2, "x")]).withColumn("version", F.monotonically_increasing_id())
    known, ledger = secrets.update(first, secrets.load_ledger(spark, folder), version="version")
    assert known.columns == ["path", "version", "blob"] and known.count() == 3 and ledger.count() == 2
    secrets.save_ledger(ledger, folder, "run-1")
    marked = secrets.load_ledger(spark, folder).withColumn("scanned", F.transform_values("scanned", lambda k, v: F.slice(v, 1, 0)))
    secrets.save_ledger(marked, folder, "run-2")
    known, ledger = secrets.update(documents([(3, "password=hunter22"), (4, "token=abcdefg")]), secrets.load_ledger(spark, folder))
    got = {r.doc_id: r.n_assign for r in secrets.report(known, ledger).collect()}
    assert got == {3: 0, 4: 1}  # what the kept ledger says of a blob is believed, and not scanned again

from errata.llm import licenses
from errata.llm.license_texts import TEMPLATES


def names(text):
    return [hit[0] for hit in licenses.Scanner(TEMPLATES).scan(text)]


def test_every_template_is_found():
    prose = "Some words that have nothing to do with it, and a few more. "
    for name, text in TEMPLATES.items():
        found = licenses.Scanner(TEMPLATES).scan(prose * 3 + "\n" + text + "\n" + prose * 3)
        assert [f[0] for f in found] == [name]
        assert (prose * 3 + "\n" + text)[found[0][1] : found[0][2]].startswith(text[:16])


def test_wording():
    assert names("Licensed under the Apache License, Version 1.1.") == []
    assert names("LICENSED under the\napache license, version 2.0") == ["Apache-2.0-notice"]
    assert names("You need a license to drive. The permission was given.") == []
    assert names("") == [] and names(None) == []
    changed = TEMPLATES["MIT"].replace("sublicense", "resell")
    assert names(changed) == ["MIT"]
    assert licenses.Scanner(TEMPLATES).scan(changed)[0][3] > 0


def test_whole_text_is_searched():
    long = "word " * 40000
    text = long + TEMPLATES["MIT-notice"] + " " + long + TEMPLATES["GPL-3.0-notice"] + " x. " + TEMPLATES["MIT-notice"]
    assert names(text) == ["MIT-notice", "GPL-3.0-notice", "MIT-notice"]


def test_report(documents):
    got = {(r.doc_id, r.n_licenses, r.names) for r in licenses.report(documents([(1, "All rights reserved."), (2, None), (3, ""), (None, "x")])).collect()}
    assert got == {(1, 1, "reserved-notice"), (2, 0, ""), (3, 0, ""), (None, 0, "")}
    assert licenses.report(documents([])).count() == 0


def test_licences_of_several_paragraphs():
    mit = TEMPLATES["MIT"].replace("conditions: ", "conditions:\n\n").replace(", to deal", ",\nto deal")
    bsd = TEMPLATES["BSD-2-Clause"].replace("met: 1.", "met:\n\n1.").replace("disclaimer. 2.", "disclaimer.\n\n2.")
    for name, text in (("MIT", mit), ("BSD-2-Clause", bsd)):
        found = licenses.Scanner(TEMPLATES).scan("A title\n\nCopyright (c) 2020 A. Holder\n\n" + text + "\n\nOther words follow here.")
        assert [f[0] for f in found] == [name]


def test_all_notices_of_a_block():
    six = ["MIT-notice", "Apache-2.0-notice", "CC-BY-4.0-notice", "CC-BY-SA-4.0-notice", "CC-BY-NC-4.0-notice", "reserved-notice"]
    assert names(" ".join(TEMPLATES[n] for n in six)) == six


def test_a_partial_quotation_hides_no_copy():
    words = TEMPLATES["MIT"].split()
    edited = [f"changed{i}" if i in (20, 40, 60) else w for i, w in enumerate(words)]
    assert names("They quote " + " ".join(words[8:50]) + " and more of it. " + "Then other words come. " * 6 + " ".join(edited)) == ["MIT"]


def plain_scan(text):
    """Every template at every run of words as long as it is, without compression: those whose words
    differ least from it, by the longest common subsequence, within the share."""
    words = [w for w, _, _ in licenses._words(text)]
    found = set()
    for name, template in TEMPLATES.items():
        wanted = [w for w, _, _ in licenses._words(template)]
        most = int(licenses.DIFFERENCES * len(wanted))
        for at in range(len(words)):
            for size in range(len(wanted) - most, len(wanted) + most + 1):
                own = words[at : at + size]
                row = [0] * (len(wanted) + 1)
                for w in own:
                    before = row[:]
                    for k, v in enumerate(wanted, 1):
                        row[k] = before[k - 1] + 1 if v == w else max(row[k - 1], before[k])
                if len(own) == size and len(wanted) + size - 2 * row[-1] <= most:
                    found.add(name)
    return found


def test_against_a_plain_scan():
    """Each text's templates are those of a scan of everything, but for those inside a longer one."""
    short = [n for n, t in TEMPLATES.items() if len(t) < 120]
    inside = {"Apache-2.0-notice", "GPL-3.0-notice", "GPL-2.0-notice", "CC-BY-4.0-sentence", "CC-BY-SA-4.0-sentence"}
    texts = [TEMPLATES[a] + " Then more follows. " + TEMPLATES[b] for a, b in zip(short, short[1:], strict=False)]
    texts += ["Licensed under the Apache License 2.0.", "All rights kept.", "Released by us under the MIT License.", "no licence here", "permission for all rights reserved"]
    for text in texts:
        got, want = set(names(text)), plain_scan(text)
        assert got <= want and want - got <= inside, text


def test_longer_template_and_its_wording():
    changed = TEMPLATES["Apache-2.0-header"].replace("compliance", "accordance")
    (hit,) = licenses.Scanner(TEMPLATES).scan(changed)
    assert (hit.name, hit.differences, hit.wording) == ("Apache-2.0-header", 2, "-compliance +accordance")
    assert names(TEMPLATES["BSD-3-Clause"]) == ["BSD-3-Clause"]

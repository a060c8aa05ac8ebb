"""License rules: the keyword gates lose nothing."""

import pytest

from kinora.llm import licenses


def ungated(ruleset, text):
    """Kept detections of all rules, each run whatever the words."""
    words = [w for w in text.encode().translate(licenses._FOLD).split(b" ") if w]
    joined, found = b" " + b" ".join(words) + b" ", []
    for rule in ruleset:
        for m in rule.pattern.finditer(joined):
            start = joined.count(b" ", 0, m.start() - 1)
            found.append((start, start + m[0].count(b" ") + 1, rule))
    return licenses.suppress(found)


def test_gates_lose_nothing():
    scanner = licenses.Scanner()
    texts = []
    for _, name, _ in licenses.LICENSES:
        for spelling in licenses.spellings(name):
            texts += [f"w released under the {spelling} w", f"w {spelling} licence version 2 w", f"w license {spelling} w", f"SPDX-License-Identifier: {spelling}"]
    texts += [s for _, pattern, _ in licenses.SENTENCES if "++" not in pattern for s in licenses.spellings(pattern)]
    assert len(texts) > 4000
    for text in texts:
        want = ungated(scanner.rules, text)
        assert want and scanner.scan(text)[2] == want, text


@pytest.mark.parametrize(
    "name,label",
    [
        ("AGPLv3", "agpl-3"), ("agpl3", "agpl-3"), ("LGPLv2", "lgpl-2"), ("LGPLv2.1", "lgpl-2.1"), ("LGPLv3", "lgpl-3"), ("GPLv1", "gpl-1"), ("GPL2", "gpl-2"),
        ("GPL3", "gpl-3"), ("MPLv2", "mpl-2"), ("MPL2", "mpl-2"), ("EPLv2", "epl-2"), ("X Consortium", "x11"), ("Creative Commons Attribution NoDeriv", "cc-by-nd"),
    ],
)
def test_glued_versions(docs_of, name, label):
    row = licenses.scan(docs_of([(1, f"This is released under the {name}.")])).first()
    assert (row["labels"], row["score"]) == (label, 0.9) and row["spans"][0]["end"] == row["n_words"]


@pytest.mark.parametrize("name", ["the university", "x " * 300, "Ünïversität für Künste und Wissenschaften " * 3, "株式会社" * 40])
def test_sentences_bridge_names_of_any_length(docs_of, name):
    bsd = f"a Neither the name of {name} nor the names of its contributors may be used to endorse or promote products b"
    cc0 = f"a To the extent possible under law, {name} has waived all copyright b"
    two = f"neither the name of a {bsd} c {bsd}"
    got = {r["doc_id"]: r for r in licenses.scan(docs_of([(1, bsd), (2, cc0), (3, two)])).collect()}
    assert [got[i]["labels"] for i in (1, 2, 3)] == ["bsd-3", "cc0-1", "bsd-3"]
    assert [[(s["start"], s["end"]) for s in got[i]["spans"]] for i in (1, 2)] == [[(1, got[i]["n_words"] - 1)] for i in (1, 2)]
    assert len(got[3]["spans"]) == 2


def test_bridges_need_both_halves():
    scanner = licenses.Scanner()
    for text in ("neither the name of x endorse", "x may be used to endorse or promote products", "neither the name of may be used to endorse or promote products"):
        assert scanner.scan(text)[2] == []
    heads = "neither the name of a " * 20_000 + "endorse"
    assert scanner.scan(heads)[2] == []

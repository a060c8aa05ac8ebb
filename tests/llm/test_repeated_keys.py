"""Near copies where one key stands on several texts."""

from kinora.llm import setjoin


def test_other_texts_of_a_key_stay(docs_of):
    one, two = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, one), (5, one), (5, two), (5, None), (7, two), (8, two + " more"), (None, one), (9, "own text"), (9, "own text")]
    kept = sorted(((r["doc_id"] or 0, r["text"]) for r in setjoin.first_of_group(docs_of(rows)).collect()), key=str)
    want = [(0, one), (1, one), (5, None), (5, two), (9, "own text"), (9, "own text")]
    assert kept == sorted(want, key=str)

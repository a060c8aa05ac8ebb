"""Terms of one or two letters give entities away too."""

import random

from kinora.llm import pii


def test_short_names(docs_of):
    rng = random.Random(7)
    common = ["al", "beta", "to", "delta", "i"]
    texts = [" ".join(rng.choices(common, k=12)) for _ in range(300)]
    texts += [f"al to Wu and 王伟 i (Q) at you@example.org {i}" for i in range(4)]
    rows = {r["doc_id"]: r for r in pii.scan(docs_of(list(enumerate(texts)))).collect()}
    for i in range(300, 304):
        hit = {texts[i][s["start"] : s["end"]] for s in rows[i]["spans"] if s["kind"] in ("term", "removed")}
        assert hit == {"Wu", "and", "王伟", "Q", "at"}
    assert not any(rows[i]["spans"] for i in range(300))

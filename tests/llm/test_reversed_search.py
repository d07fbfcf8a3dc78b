import math
import re
from collections import Counter

import oracle

from candleworks.llm import oracles, reversed_search
from candleworks.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain_search(docs, items, top):
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, counts in held:
            m = 75 + 25 * sum(counts.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 12 * m))
                for t in plain_terms(text) if t in counts
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def rows(frame):
    return sorted(map(tuple, frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, score string")


def test_same_as_sql(spark):
    name = "op13_reversed_search"
    assert oracle.differences(spark, oracle.connect(SF), SF, QUERIES[name], oracles.SQL[name]) == []


def test_against_plain(spark, documents, awkward, monkeypatch):
    texts = awkward + [f"alpha beta {'gamma ' * (k % 7)}tail{k % 3}" for k in range(60)] + ["copy of alpha"] * 50
    docs = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(5, "alpha alpha"), (5, "alpha alpha")]
    items = [(0, "Alpha BETA alpha"), (1, "gamma_tail1-tail2"), (2, None), (3, "nothing of it"), (3, "copy"), (3, "copy"), (None, "한국어 one")]
    want = plain_search(docs, items, 20)
    assert want == rows(reversed_search.search(documents(docs).repartition(6), items_of(spark, items)))
    # Items in several blocks, and scores in small steps.
    monkeypatch.setattr(reversed_search, "BLOCK_ITEMS", 2)
    monkeypatch.setattr(reversed_search, "STEP", 3)
    assert plain_search(docs, items, 3) == rows(reversed_search.search(documents(docs).repartition(3), items_of(spark, items), top=3))


def test_empty_tables(spark, documents):
    assert rows(reversed_search.search(documents([]), items_of(spark, [(1, "a")]))) == []
    assert rows(reversed_search.search(documents(["a b"]), items_of(spark, []))) == []
    assert rows(reversed_search.search(documents([None, ""]), items_of(spark, [(1, "a")]))) == []

import random
import re
import zlib
from collections import Counter

import numpy as np
import oracle
import pytest

from candleworks.llm import letter_trees, oracles
from candleworks.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_counts(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def plain_groups(n):
    form, out = {}, []
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = (len(others), best if best and n[best] >= 5 * n[w] else None)
    for w, (k, f) in form.items():
        root = w
        while form[root][1]:
            root = form[root][1]
        out.append((w, n[w], k, f, n[f] if f else None, root))
    return sorted(out)


def rows(frame):
    return sorted(map(tuple, frame.select("word", "n", "n_near", "form", "form_n", "root").collect()))


def test_same_as_sql(spark):
    name = "op12_letter_trees"
    assert oracle.differences(spark, oracle.connect(SF), SF, QUERIES[name], oracles.SQL[name]) == []


@pytest.mark.parametrize("cell", [4096, 40])
def test_against_plain(spark, documents, awkward, cell, monkeypatch):
    monkeypatch.setattr(letter_trees, "CELL", cell)
    monkeypatch.setattr(letter_trees, "LEAF", 4)
    monkeypatch.setattr(letter_trees, "STEP", 900)
    rng = random.Random(cell)
    words = ["".join(rng.choices("abéè", k=rng.randrange(6, 10))) for _ in range(500)]
    words += ["stressed", "desserts", "stresses", "stressedd", "xstressed", "ÀÉÎÕÜß", "x" * 3000, "x" * 2999 + "y"]
    times = {w: rng.choice([1, 5, 6, 30, 200, 1200]) for w in words} | {"chainaaa": 5, "chainaab": 30, "chainabb": 200, "chainbbb": 1100}
    texts = [" ".join(rng.sample(words, 60)) for _ in range(20)]
    docs = list(enumerate(texts + awkward)) + [(None, "Nameless-NAMELESS " * 40), (7, "same same repeated " * 9), (7, "same same repeated " * 9)]
    docs += [(1000 + i, f"{w} " * n) for i, (w, n) in enumerate(times.items())]
    want = plain_groups(plain_counts(docs))
    assert rows(letter_trees.grouped(documents(docs).repartition(4))) == want
    assert {w[5]: w[0] for w in want if w[0] == "chainaaa"} == {"chainbbb": "chainaaa"}
    assert sum(w[2] for w in want) > 100


def test_empty_tables(spark, documents):
    for docs in ([], [None, "", "too few words"]):
        assert rows(letter_trees.grouped(documents(docs))) == []


def test_trees_lose_nothing():
    """Every point within the distance is found, whatever the tree's leaves hold."""
    rng = np.random.default_rng(3)
    points = rng.integers(0, 4, (600, 5)).astype(np.int32)
    queries = rng.integers(0, 5, (200, 5)).astype(np.int32)
    for leaf in (1, 7, 1000):
        tree = letter_trees.Tree(points, leaf)
        found = {(int(q), int(p)) for a, b in tree.within(queries, 2) for q, p in zip(a, b)}
        distance = np.abs(queries[:, None] - points[None]).sum(2)
        assert found == {(int(q), int(p)) for q, p in zip(*np.nonzero(distance == 2))}
        assert leaf > 600 or max(map(len, tree.leaves)) < 100

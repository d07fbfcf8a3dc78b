import hashlib
from collections import Counter

import numpy as np

from candleworks.llm import weighted_sampling as ws


def similarity(a, b):
    a, b = Counter(ws.words(a)), Counter(ws.words(b))
    return (a & b).total() / (a | b).total()


def test_collisions_estimate_generalised_jaccard():
    rng = np.random.default_rng(2)
    sampler, errors = ws.Sampler(), []
    for turn in range(300):  # terms of their own, so that the errors are independent
        a, b = (" ".join(f"t{turn}-{i}" for i in rng.zipf(1.3, 80) if i < 500) for _ in range(2))
        errors.append(ws.likeness(sampler.sample(a), sampler.sample(b)) - similarity(a, b))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.08


def test_weights_matter_and_order_does_not():
    sampler = ws.Sampler()
    a, b, c = (sampler.sample(t) for t in ("x y z x", "z x x y", "x y z"))
    assert (a == b).all() and not (a == c).all()
    assert ws.likeness(sampler.sample(None), sampler.sample(" ")) == 1.0
    assert ws.likeness(sampler.sample(None), c) == 0.0


def test_forgetting_and_steps_change_nothing(monkeypatch):
    texts = [" ".join(f"w{(i * j) % 300}" for j in range(50)) for i in range(40)]
    want = [ws.as_text(ws.Sampler().sample(t)) for t in texts]
    monkeypatch.setattr(ws, "REMEMBERED", 60)
    monkeypatch.setattr(ws, "STEP", 7)
    sampler = ws.Sampler()
    assert [ws.as_text(sampler.sample(t)) for t in texts] == want


def test_known_pairs_take_no_room_in_the_table(monkeypatch):
    monkeypatch.setattr(ws, "REMEMBERED", 60)
    drawn, draw = [], ws.draw
    monkeypatch.setattr(ws, "draw", lambda terms, weights: drawn.append(len(terms)) or draw(terms, weights))
    sampler, text = ws.Sampler(), " ".join(f"w{i}" for i in range(40))
    first = sampler.sample(text)
    assert (sampler.sample(text + " w0 w1 w2") == sampler.sample(text + " w0 w1 w2")).all()
    assert (sampler.sample(text) == first).all()
    assert (sum(drawn), sampler.young) == (43, 0)  # the table was not begun anew for pairs it holds


def by_definition(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    sampler, out = ws.Sampler(), []
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        marks = [sampler.sample(t) for t in (text, new, following)]
        out.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), ws.as_text(marks[0]), ws.as_text(marks[1]), ws.likeness(*marks[:2]), ws.likeness(marks[0], marks[2])))
    return sorted(out, key=repr)


def test_against_brute_force(small, documents, awkward):
    for frame in (small("documents"), documents(awkward), documents([(5, "only one text")]), documents([(1, "b b"), (1, "a a"), (0, "c"), (None, "d e")])):
        rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
        for ranges in (1, 3, 40):
            got = ws.compared(frame, ranges).collect()
            assert sorted((tuple(r) for r in got), key=repr) == by_definition(rows), ranges
    assert ws.compared(documents([])).count() == 0
    assert ws.fingerprints(documents(awkward)).count() == len(awkward)

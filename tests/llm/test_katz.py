import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from candleworks.llm import katz

def learn():
    return F.crc32(F.col("doc_id").cast("string")) % 7 != 2



class Plain:
    """Katz backoff with dicts, one n-gram at a time."""

    def __init__(self, texts, order):
        self.order, self.counts = order, [Counter() for _ in range(order)]
        self.texts = 0
        for text in texts:
            line = [" ", *self.words(text)]
            self.texts += 1
            for i in range(1, len(line)):
                for k in range(1, order + 1):
                    if i - k + 1 >= 0:
                        self.counts[k - 1][tuple(line[i - k + 1 : i + 1])] += 1
        self.n = sum(self.counts[0].values())
        self.discounts = []
        for c in self.counts:
            times = Counter(c.values())
            import numpy as np

            self.discounts.append(katz.Discounts.of(np.array([times[r] for r in range(katz.RELIABLE + 3)])))
        self.after = [{} for _ in range(order)]
        for k, c in enumerate(self.counts):
            for gram in c:
                self.after[k].setdefault(gram[:-1], []).append(gram[-1])

    @staticmethod
    def words(text):
        return [w.decode() for w in (text or "").encode().lower().split()] + [""]

    def kept(self, k, c):
        d = self.discounts[k - 1]
        return c - d.less if c > katz.RELIABLE else d.share[c] * c

    def times(self, history):
        return self.texts if history == (" ",) else self.counts[len(history) - 1][history]

    def p(self, history, word):
        k = len(history) + 1
        if k == 1:
            if not self.n:
                return 1.0
            c = self.counts[0][(word,)]
            return self.kept(1, c) / self.n if c else 1 - sum(self.kept(1, v) for v in self.counts[0].values()) / self.n
        if not self.times(history):
            return self.p(history[1:], word)
        c = self.counts[k - 1][(*history, word)]
        if c:
            return self.kept(k, c) / self.times(history)
        return self.alpha(history) * self.p(history[1:], word)

    def alpha(self, history):
        k, after = len(history) + 1, self.after[len(history)].get(history, [])
        left = 1 - sum(self.kept(k, self.counts[k - 1][(*history, w)]) for w in after) / self.times(history)
        return left / (1 - sum(self.p(history[1:], w) for w in after))

    def score(self, text):
        line = [" ", *self.words(text)]
        return sum(math.log10(self.p(tuple(line[max(0, i - self.order + 1) : i]), line[i])) for i in range(1, len(line)))

    def base(self, text):
        v = len(self.counts[0])
        return sum(math.log10((self.counts[0][(w,)] + 1) / (self.n + v + 1)) for w in self.words(text))


def against_plain(rows, found, order):
    import zlib

    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False for i, _ in rows}
    plain = Plain([t for i, t in rows if not held[i]], order)
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t)
    for r in found:
        if len(texts[r.doc_id]) > 1:
            continue
        words = plain.words(texts[r.doc_id][0])
        assert (r.learnt, r.n_tokens, r.train_tokens) == (not held[r.doc_id], len(words), plain.n)
        assert r.n_known == sum(plain.counts[0][(w,)] > 0 for w in words)
        assert r.base_score == pytest.approx(plain.base(texts[r.doc_id][0]), rel=1e-9, abs=1e-9)
        assert r.score == pytest.approx(plain.score(texts[r.doc_id][0]), rel=1e-9, abs=1e-9)
    return plain


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_against_plain(spark, documents, awkward, order, monkeypatch):
    monkeypatch.setattr(katz, "SLICE_CHARS", 3_000)
    rng = random.Random(order)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=rng.randrange(1, 60))) for _ in range(120)]
    rows = list(enumerate(texts + awkward[:-1] + ["the same copy of it " * 30] * 3 + ["odd words only here"]))
    found = katz.scored(documents(rows).repartition(5), learn(), order).collect()
    plain = against_plain(rows, found, order)
    # All words and the unknown one add up to 1 after any history.
    histories = {tuple(h[:-1]) for h in list(plain.counts[order - 1])[:40]} | {("odd",) * (order - 1)}
    known = [w for (w,) in plain.counts[0]]
    for history in histories:
        assert sum(plain.p(history, w) for w in [*known, "never seen"]) == pytest.approx(1, abs=1e-9)


def test_odd_tables(spark, documents, awkward):
    assert katz.scored(documents([]), learn()).collect() == []
    rows = [(None, "a b c"), (None, None), (4, "a b"), (4, "a b"), (5, ""), (6, None)]
    found = katz.scored(documents(rows), learn()).collect()
    against_plain(rows, found, 2)
    assert len({r.score for r in found if r.doc_id == 4}) == 1
    # Nothing to learn from: all words are unknown, with probability 1.
    found = katz.scored(documents(awkward), F.lit(False)).collect()
    assert {(r.score, r.base_score, r.n_known, r.train_tokens) for r in found} == {(0.0, 0.0, 0, 0)}


def test_query_on_the_small_tables(spark, small):
    from candleworks.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in small("documents").collect()]
    found = QUERIES["op11_katz_backoff"](spark, "/root/testdata/sf0.001").withColumn("learnt", ~F.col("held_out"))
    against_plain(rows, found.collect(), katz.ORDER)
    held = found.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]

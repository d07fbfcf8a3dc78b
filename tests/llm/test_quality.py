from collections import Counter

import numpy as np

from candleworks.llm import quality, queries


def plain_counts(text):
    """The base counts by their definition."""
    words = [w for w in (text or "").replace("\v", " ").replace("\f", " ").replace("\r", " ").replace("\t", " ").replace("\n", " ").split(" ") if w]
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\v\f\r")]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(inside),
    )


def test_base_counts(small, awkward):
    texts = awkward + ["a b c a b c\na b c\n\na b c", "x | y <z> #\n x | y <z> #\n"]
    texts += [r[0] for r in small("documents").select("text").collect()]
    for text in texts:
        assert quality.base_counts(text) == plain_counts(text)


def test_ngram_counts_and_scores_by_hand(documents):
    texts = ["abcab", "ab", "x", "", None, "abcab"]
    docs = documents(texts)
    raw, target = quality.count_ngrams(docs, np.array([1]))
    grams = Counter(t[i : i + n] for t in texts if t for n in quality.NGRAMS for i in range(len(t) - n + 1))
    assert raw.sum() == sum(grams.values()) and target.sum() == 1
    ratios = np.arange(len(raw)) % 97 - 40
    codes = {g: np.array([ord(c) for c in g], np.uint32) for g in grams}
    value = {g: ratios[quality.ngram_buckets(c, len(g), quality.BITS)[0]] for g, c in codes.items()}
    for text, score in zip(texts, quality.llr_scores(texts, ratios)):
        own = [value[text[i : i + n]] for n in quality.NGRAMS for i in range(len(text or "") - n + 1)]
        assert abs(score - (sum(own) / quality.UNIT / len(own) if own else 0)) < 1e-12


def test_threshold():
    assert quality.best_threshold([]) == float("-inf")
    assert quality.best_threshold([(0.0, 5, 0)]) == float("-inf")
    cut = quality.best_threshold([(-2.0, 0, 3), (-1.0, 1, 2), (0.5, 9, 0)])
    assert -1.0 < cut < 0.5


def test_good_documents_stay_and_junk_goes(spark):
    rows = queries.QUERIES["op3_quality_llr"](spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    both = rows[~rows.base_failed].merge(labels, on="doc_id")
    assert both[both.quality == 1].kept.mean() > 0.97
    assert both[both.quality == 0].kept.mean() < 0.1
    assert not rows[rows.base_failed].kept.any() and len(rows) == 1000


def test_awkward_and_empty_tables(documents, labels, awkward):
    none = labels([])
    got = quality.judge(documents(awkward), none).collect()
    assert len(got) == len(awkward) and not [r for r in got if r["n_words"] < 50 and r["kept"]]
    assert quality.judge(documents([]), none).count() == 0
    assert quality.judge(documents([(None, "a b " * 60)]), none).first()["base_failed"]


def test_fit_reads_the_threshold_off_all_labels(spark, monkeypatch):
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("documents", "labels"))
    monkeypatch.setattr(quality, "MAX_TRUSTED", 12)
    ratios = quality.log_ratios(*quality.count_ngrams(docs, quality.trusted_ids(marks)))
    assert quality.fit(docs, marks).threshold == quality.threshold(quality.score(docs, ratios), marks)

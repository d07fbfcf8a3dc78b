"""Language identification and toxicity: held-out accuracy and awkward input."""

import numpy as np
import pytest

from candleworks.llm import langid, queries, subwords, toxicity

SF = "/root/testdata/sf0.01"


def test_held_out_language(spark):
    rows = queries.QUERIES["op6_language_subwords"](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    both = rows.merge(docs, on="doc_id")
    assert len(rows) == 1000 and rows.score.between(0, 1).all()
    assert (both[both.held_out].lang == both[both.held_out].lang_pred).mean() > 0.97
    assert both.rejected.mean() < 0.02


def test_language_of_awkward_texts(documents, awkward):
    words = {"en": "the house and the tree ", "fr": "le maison et un arbre "}
    docs = documents([(i, words["en"] * 5) for i in range(30)]).union(documents([(i, words["fr"] * 5) for i in range(30, 60)], "fr"))
    model = langid.fit(docs)
    got = model.predict(["the tree", "un arbre", None, "", " \n", "123 !?", "le arbre et le arbre"])
    assert got.lang_pred.tolist() == ["en", "fr", "und", "und", "und", "und", "fr"]
    assert (got.score[2:6] == 0).all() and got.rejected[2:6].all()
    assert model.predict(["un arbre"] * 2 + ["x" * 3_000_000]).score.nunique() == 2
    out = langid.identify(documents(awkward), model)
    assert len(out.columns) == len(documents(awkward).columns) + 1 and out.count() == len(awkward)
    assert langid.identify(documents([]), model).count() == 0


def test_language_without_labels(documents):
    model = langid.fit(documents(["a b", "c d"], None))
    assert model.predict(["a b", None]).lang_pred.tolist() == ["und", "und"]


def test_toxicity_on_held_out_rows(spark):
    rows = queries.QUERIES["op8_toxicity_subwords"](spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    assert len(rows) == 10_000 and rows.score.between(0, 1).all()
    assert (rows.predicted == (rows.score >= 0.7)).all()
    held = rows[rows.held_out].merge(labels, on="doc_id")
    bad = held.toxic == 1
    rank = held.score.rank()
    auc = (rank[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert auc > 0.93
    assert held[bad].predicted.mean() > 0.7 and held[~bad].predicted.mean() < 0.01


@pytest.fixture(scope="module")
def rude():
    rng = np.random.default_rng(1)
    clean = "garden river stone window paper cloud bread table light music".split()
    texts, labels = [], []
    for i in range(400):
        words = list(rng.choice(clean, 40))
        if i % 4 == 0:
            words[rng.integers(40)] = rng.choice(["scoundrel", "blockhead"])
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return toxicity.train(texts, labels)


def test_one_word_in_a_long_text_and_misspellings(rude):
    clean = "garden river stone window paper cloud bread table light music " * 40
    scores = rude.scores([clean, clean + "blockhead " + clean, clean + " blokhead scoundrl", "", None, "12 34"])
    assert scores[1] > 0.7 > 0.3 > scores[0]
    assert scores[2] > scores[0] and (scores[3:] < 0.1).all()
    assert rude.scores([clean]) == rude.scores([None, clean])[1]


def test_windows_by_hand():
    texts = ["aa bb cc", "", "dd", " 1 ee  ff "]
    codes, starts, ends = subwords.prepared(texts)
    got = {}
    for s, e, o in zip(*toxicity.windows(codes, starts, ends)):
        got.setdefault(o, []).append("".join(map(chr, codes[s:e])))
    assert got == {0: [" aa bb ", " bb cc "], 2: [" dd "], 3: [" ee  ff "]}


def test_toxicity_of_awkward_tables(documents, labels, awkward, rude):
    assert toxicity.scored(documents(awkward), rude).count() == len(awkward)
    assert toxicity.scored(documents([]), rude).count() == 0
    model = toxicity.fit(documents(awkward), labels([]))
    assert not toxicity.scored(documents(awkward), model).where("score != 0").count()
    model = toxicity.fit(documents(["a b", "c d"]), labels([(0, 1, 1), (0, 1, 1), (1, None, None)]))
    assert model.scores(["a b"]) == [0.0]


def test_contradicting_labels_are_counted(documents, labels, monkeypatch):
    """The more frequent label of an id counts, at a tie the toxic one."""
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic, counts: (dict(zip(texts, toxic)), counts))
    given = labels([(0, 1, 0), (0, 1, 1), (0, 1, 0), (1, 1, 1), (1, 1, 0), (2, 1, 0), (2, 1, None), (None, 1, 1)])
    assert toxicity.fit(documents(["a", "b", "c", "d"]), given) == ({"a": 0, "b": 1, "c": 0}, (2, 1))


def test_rejection_level_is_the_calibrated_one():
    """Two languages: the larger chance is never below a half, and yet foreign text is rejected."""
    rng = np.random.default_rng(3)
    words = {"en": "the house and tree with water bird".split(), "fr": "le maison et un arbre avec oiseau".split()}
    langs = ["en", "fr"] * 200
    model = langid.train([" ".join(rng.choice(words[v], 30)) for v in langs], langs)
    assert model.reject_below > 0.5
    foreign = ["the house and tree with water bird le maison et un arbre avec oiseau", "qzxj vkpg wqxz jjkq"]
    assert model.predict(foreign).rejected.all()
    clean = [" ".join(rng.choice(words[v], 30)) for v in langs]
    assert model.predict(clean).rejected.mean() < 0.05

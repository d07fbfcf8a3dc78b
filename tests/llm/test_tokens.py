"""Packing and piece encoding against the libraries."""

import hashlib
import random

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from candleworks.llm import packing, piece_bpe, queries

ODD = [
    "", " ", "  ", "▁▁x ▁", "a\n\n b\t", "héé 한국어 🙂🙂 ²½Ⅷ x_y __ 日本語", "aaaaaaaaaaaaaaaa", "\x00a", "</s><unk> <0x0A>", None,
    "<|ENDOFTEXT|> a.b,  xy . , ., é. é, A. <|endoftext|>y", "it's I'll ΣΑΣ İ e ́x \x1cq ​",
]


def mixed(seed, count, longest=60):
    rng = random.Random(seed)
    letters = "abcdetinorsh  \n.,;!()0123é▁한🙂_日本'"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(longest))) for _ in range(count)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_bpe.VOCABULARY))


def test_pieces_equal_the_library(library, small):
    table = piece_bpe.piece_table(public_tokenizers.path(piece_bpe.VOCABULARY))
    rng = random.Random(5)
    pieces = sorted(table.id_of)
    texts = ODD + mixed(1, 1_500) + ["".join(rng.choice(pieces) for _ in range(8)) for _ in range(1_500)]
    texts += [r.text for r in small("documents").select("text").collect()]
    for text in texts:
        ids = library.encode(text or "")
        assert table.encode(text) == ids
        assert table.decode(ids) == library.decode(ids)
        back = library.decode(ids)
        digests = [hashlib.sha256(s.encode()).hexdigest() for s in (",".join(map(str, ids)), back)]
        assert table.digests(text) == (len(ids), *digests)


def test_encoded_documents(documents, awkward, library):
    rows = piece_bpe.encoded(documents(awkward)).collect()
    assert [r.ids for r in rows] == [library.encode(t or "") for t in awkward]
    assert [r.decoded for r in rows] == [library.decode(library.encode(t or "")) for t in awkward]
    assert piece_bpe.encoded_digests(documents([])).count() == 0


def test_word_ids_equal_the_library(small):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    words = packing.WordIds(public_tokenizers.path(packing.VOCABULARY))
    texts = ODD + mixed(2, 1_500) + [r.text for r in small("documents").select("text").collect()]
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert words.encode(texts) == want


def check_packing(pieces: pd.DataFrame, totals: dict, limits: packing.Limits, loss=None):
    """loss: a list of 0 and 1 per document; by default all tokens bear loss."""
    got = {}
    for doc, own in pieces.sort_values("start").groupby("doc_id"):
        assert (own.start.to_numpy() == np.concatenate([[0], own.length.cumsum()[:-1]])).all()
        got[doc] = own.length.sum()
        assert (own.doc_tokens == totals[doc]).all()
    assert got == totals
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert (own.offset.to_numpy() == np.concatenate([[0], own.length.cumsum()[:-1]])).all()
        assert own.length.sum() <= limits.tokens and len(own) <= limits.segments
        assert own.loss_tokens.sum() <= limits.loss_tokens
    for r in pieces.itertuples():
        assert r.loss_tokens == (r.length if loss is None else sum(loss[r.doc_id][r.start : r.start + r.length]))


@pytest.mark.parametrize("seed", range(4))
def test_bins_hold_all_three_limits(seed):
    rng = random.Random(seed)
    limits = packing.Limits(tokens=64, segments=5, loss_tokens=40)
    lengths = {i: rng.choice([1, 2, rng.randrange(1, 40), rng.randrange(1, 300)]) for i in range(400)}
    spans, mask = {}, {}
    for i, n in lengths.items():
        at = rng.randrange(n + 1)  # none, all, the tail, or overlapping spans beyond the end
        spans[i] = rng.choice([[], None, [(at, None)], [(n // 3, n // 2), (n // 4, n // 2 + 1), (n - 1, n + 9)]])
        own = [(0, n)] if spans[i] is None else [(s, n if e is None else e) for s, e in spans[i]]
        mask[i] = [int(any(s <= k < e for s, e in own)) for k in range(n)]
    packer, rows = packing.Packer(limits), []
    for i, n in lengths.items():
        rows += [*packer.add(i, np.arange(n, dtype="<u4").tobytes(), packing.loss_before(n, spans[i])), *packer.ready()]
    rows += packer.finish()
    pieces = pd.DataFrame(rows, columns=packing._COLUMNS)
    check_packing(pieces, lengths, limits, mask)
    for r in pieces.itertuples():
        assert np.frombuffer(r.ids, "<u4").tolist() == list(range(r.start, r.start + r.length))


def test_loss_at_the_tail_binds_through_packed(spark):
    """300 instruction rows of 41 tokens, the last 11 with loss: at most 3 to a bin of 4096."""
    text = " ".join(["word"] * 40)
    docs = spark.createDataFrame([(i, text, [(30, 41)]) for i in range(300)], "doc_id long, text string, spans array<struct<s:int,e:int>>")
    limits = packing.Limits(loss_tokens=33)
    pieces = packing.packed(docs, limits, loss="spans").toPandas()
    mask = [0] * 30 + [1] * 11
    check_packing(pieces, {i: 41 for i in range(300)}, limits, {i: mask for i in range(300)})
    bins = pieces.groupby("sequence_id").loss_tokens.sum()
    assert pieces.loss_tokens.sum() == 3300 and len(bins) >= 100 and bins.max() == 33
    free = packing.packed(docs.withColumn("spans", F.expr("if(doc_id = 0, null, slice(spans, 1, 0))")), limits, loss="spans")
    got = free.groupBy("doc_id").agg(F.sum("loss_tokens")).collect()
    assert dict(got) == {i: 41 if i == 0 else 0 for i in range(300)}
    with pytest.raises(ValueError):
        packing.Packer(packing.Limits(loss_tokens=0))


def test_packed_documents(spark, small, documents, awkward):
    docs = small("documents")
    pieces = packing.packed(docs).toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    ids = {r.doc_id: tokenizer.encode(r.text, add_special_tokens=False).ids + [2] for r in docs.collect()}
    check_packing(pieces, {d: len(v) for d, v in ids.items()}, packing.Limits())
    for r in pieces.itertuples():
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id][r.start : r.start + r.length]
    filled = pieces.groupby("sequence_id").length.sum()
    assert all(n == 4096 or n & (n - 1) == 0 for n in filled)
    odd = packing.packed(documents(awkward)).toPandas()
    assert set(odd.doc_id) == set(range(len(awkward))) and odd[odd.doc_id == 0].doc_tokens.tolist() == [1]
    assert packing.packed(documents([])).count() == 0
    assert packing.packed(documents([(None, "a"), (None, "a")])).count() == 2


def test_registered_packing_and_pieces(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    pieces = queries.QUERIES["op10_packing_vector"](spark, sf_dir)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(pieces.columns)
    assert pieces.selectExpr("count(distinct doc_id)").first()[0] == 200
    rows = queries.QUERIES["op4_piece_prefix_table"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(library.encode(t)) for i, t in texts.items()}

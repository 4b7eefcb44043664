"""Operator 11 against the library on whole texts."""

import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from tickloom.llm import sentencepieces

from .conftest import DOCS

BODY = sentencepieces.read_model()
LIBRARY = SentencePieceProcessor(model_proto=BODY)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    out = []
    for doc_id, text in rows:
        ids = LIBRARY.encode(text or "")
        out.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))))
    return Counter(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r▁　 ab.é日本\0😀"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_chunks_have_the_pieces_of_the_text(text):
    model = sentencepieces.opened_model(BODY)
    chunks = model.chunks(text)
    assert [i for ids in model.ids(chunks) for i in ids] == LIBRARY.encode(text)


@pytest.mark.parametrize("shard_bytes", [6 << 20, 1500])
def test_texts_equal_the_library(spark, shard_bytes):
    rng = random.Random(4)
    words = ["the", "  ", "\n", "\n\n", "</s>", "<s>", "<0x41>", "▁", "日本語", "naïve", "ﬁ", "x" * 300, "\t\r\n", "😀", "don't", "3.14159", ""]
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", str(rng.randint(0, 99))]) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    rows += [(90, None), (91, ""), (92, " "), (93, "   lead"), (94, "trail   "), (None, "no id"), (None, "no id"), (5, rows[5][1]), (95, "a" * 50_000), (96, "ab c " * 20_000)]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    got = sentencepieces.digest(sentencepieces.encode(docs, shard_bytes=shard_bytes)).collect()
    assert Counter(map(tuple, got)) == plain(rows)


def test_documents_equal_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sentencepieces.digest(sentencepieces.encode(docs)).collect()
    assert Counter(map(tuple, got)) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_messy(spark, messy, empty):
    rows = [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    assert Counter(map(tuple, sentencepieces.digest(sentencepieces.encode(messy)).collect())) == plain(rows)
    assert sentencepieces.digest(sentencepieces.encode(empty)).count() == 0


def test_rows_without_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, LIBRARY.encode("a b"))], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in sentencepieces.decode(rows).collect()} == {1: "", 2: "", 3: "a b"}


@pytest.mark.parametrize("change", ["crossing", "spaces"])
def test_models_that_do_not_fit_are_refused(change):
    proto = sentencepiece_model_pb2.ModelProto.FromString(BODY)
    if change == "spaces":
        proto.normalizer_spec.remove_extra_whitespaces = True
    else:
        proto.pieces[5000].piece = "a▁b"
    with pytest.raises(ValueError):
        sentencepieces.Model(proto.SerializeToString())

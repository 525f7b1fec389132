"""Texts of several million bytes through every operator on texts; vectors and repeated strings have such tests of their own."""

import hashlib
import json

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tabflow.llm import gru_langid, quality_mil
from tabflow.llm.golay_simhash import fingerprint, simhash_groups
from tabflow.llm.line_windows import drop_repeated_lines
from tabflow.llm.piece_agenda import encode_decode
from tabflow.llm.queries import BYTE_VOCABULARY, PIECE_VOCABULARY, vocabulary
from tabflow.llm.token_count import count_tokens

LINES = [f"line {i % 50_000} of a long text, with some words" for i in range(60_000)]
LONG = "\n".join(LINES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(1, "a short text", "en"), (2, LONG, "en"), (3, "word" * 500_000, "en"), (4, "ein kurzer Text", "de")],
                                 "doc_id long, text string, lang string")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_scores_and_languages(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1)], "doc_id long, quality int")
    model = quality_mil.learn(docs, labels, folds=1, held=5)
    assert all(0 <= r.score <= 1 for r in quality_mil.score_quality(docs, model).collect())
    found = by_id(gru_langid.identify(docs, gru_langid.learn(docs, folds=1, held=5)))
    assert len(found) == 4 and found[2].lang_pred in ("de", "en")


def test_tokens(docs):
    library = Tokenizer.from_str(vocabulary(BYTE_VOCABULARY).decode())
    got = by_id(count_tokens(docs, vocabulary(BYTE_VOCABULARY)))
    assert got[2].n_tokens == len(library.encode(LONG, add_special_tokens=False).ids) and got[2].n_bytes == len(LONG) and got[2].over_limit
    assert json.loads(vocabulary(BYTE_VOCABULARY))["model"]["type"] == "BPE"


def test_pieces(docs):
    library = sentencepiece.SentencePieceProcessor(model_proto=vocabulary(PIECE_VOCABULARY))
    got = by_id(encode_decode(docs, vocabulary(PIECE_VOCABULARY)))
    ids = library.encode(LONG, add_eos=True)
    assert got[2].n_tokens == len(ids)
    assert got[2].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_lines(docs):
    """The last ten thousand lines are repeats of the first."""
    got = by_id(drop_repeated_lines(docs))
    assert got[2].n_removed == 10_000 and got[2].text == "\n".join(LINES[:50_000]) and got[3].text == "word" * 500_000


def test_fingerprints(docs):
    got = by_id(simhash_groups(docs))
    assert got[2].fingerprint == f"{fingerprint(LONG):016x}" and got[3].fingerprint == f"{fingerprint('word' * 500_000):016x}"

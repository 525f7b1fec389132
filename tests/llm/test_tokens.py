import hashlib

import public_tokenizers
import pytest
import sentencepiece
from pyspark.errors import PySparkException
from tokenizers import Tokenizer

from tabflow.llm.piece_agenda import PieceModel, encode_decode
from tabflow.llm.queries import BYTE_VOCABULARY, PIECE_VOCABULARY, QUERIES, vocabulary
from tabflow.llm.token_count import TokenCounter, count_tokens


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(public_tokenizers.path(BYTE_VOCABULARY))


@pytest.fixture(scope="module")
def piece_library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE_VOCABULARY))


def library_counts(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_of_odd_texts(spark, byte_library, odd_texts):
    rows = [(i, t, "x") for i, t in enumerate(odd_texts)] + [(None, "null id", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = {r.doc_id: r for r in count_tokens(df, vocabulary(BYTE_VOCABULARY), limit=100).collect()}
    for i, t, _ in rows:
        expected = library_counts(byte_library, [t or ""])[0]
        assert (found[i].n_bytes, found[i].n_tokens) == (len((t or "").encode()), expected), t
        assert found[i].over_limit == (expected > 100)


def test_counts_of_every_character(byte_library):
    counter = TokenCounter(vocabulary(BYTE_VOCABULARY))
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1 {chr(c)}." for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    expected = library_counts(byte_library, texts)
    latin = "".join(map(chr, range(0x180)))
    texts += [f"{a}{b} {b}{a} x{a}1{b}" for a in latin for b in "a1 .'\n\xa0"]
    expected += library_counts(byte_library, texts[len(expected):])
    wrong = [i for i, t in enumerate(texts) if counter.count(t) != expected[i]]
    assert not wrong, [texts[i] for i in wrong]


def test_whole_tokens_are_proven(byte_library):
    counter = TokenCounter(vocabulary(BYTE_VOCABULARY))
    assert len(counter.whole) > 40_000
    sample = sorted(counter.whole)[::97]
    for word, n in zip(sample, library_counts(byte_library, sample)):
        assert counter.count(word) == n, word


def test_count_query(spark, sf_dir, byte_library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op2_token_counts"](spark, sf_dir).collect()
    expected = dict(zip(texts, library_counts(byte_library, list(texts.values()))))
    assert {r.doc_id: r.n_tokens for r in found} == expected
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 1024) for r in found)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert count_tokens(empty, vocabulary(BYTE_VOCABULARY)).count() == 0
    assert encode_decode(empty, vocabulary(PIECE_VOCABULARY)).count() == 0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_pieces_of_odd_texts(spark, piece_library, odd_texts):
    rows = [(i, t, "x") for i, t in enumerate(odd_texts)] + [(None, "null id", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = {r.doc_id: r for r in encode_decode(df, vocabulary(PIECE_VOCABULARY), with_ids=True).collect()}
    for i, t, _ in rows:
        ids = piece_library.encode(t or "", add_eos=True)
        assert found[i].token_ids == ids, t
        assert found[i].decoded == piece_library.decode(ids), t
        assert found[i].n_tokens == len(ids)


def test_pieces_of_every_character(piece_library):
    model = PieceModel(vocabulary(PIECE_VOCABULARY))
    points = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}b {chr(c)}" for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    for text, ids in zip(texts, piece_library.encode(texts, num_threads=1)):
        assert model.encode(text, end=False) == ids, text
        assert model.decode(ids) == piece_library.decode(ids)


def test_piece_query(spark, sf_dir, piece_library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op9_sentencepiece"](spark, sf_dir).collect():
        ids = piece_library.encode(texts[r.doc_id], add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == sha(piece_library.decode(ids))


def test_a_wrong_cut_into_words_is_found(spark, monkeypatch):
    """Whole texts are held against the library too, so words that are right one by one don't hide a wrong cut."""
    begin = PieceModel.__init__

    def wrong(self, data):
        begin(self, data)
        self.pattern = "(?s:.)"

    monkeypatch.setattr(PieceModel, "__init__", wrong)
    df = spark.createDataFrame([(1, "several words in a text")], "doc_id long, text string")
    with pytest.raises(PySparkException, match="differs from the library"):
        encode_decode(df, vocabulary(PIECE_VOCABULARY)).collect()
    assert encode_decode(df, vocabulary(PIECE_VOCABULARY), check=False).count() == 1

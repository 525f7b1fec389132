import hashlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from test_lines_packing import check_packing, plain_dedup
from test_repeats import plain_removal
from test_simhash import plain_groups

from tabflow.llm.quality_mil import learn, score_quality


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def as_rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """The rows before and after every stage, as the pipeline runs them."""
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    seen.append(docs.collect())
    for i, (_, run) in enumerate(corpus_pipeline.STAGES):
        out = run(spark, docs, sf_dir)
        if i < 4:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        path = str(tmp_path_factory.mktemp("stage") / "out")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append(docs.collect())
    return seen


def test_rejects(spark, sf_dir, stages):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = {r.doc_id: r.score for r in score_quality(docs, learn(docs, labels)).collect()}
    assert sorted(r.doc_id for r in stages[1]) == sorted(i for i, s in scores.items() if s >= 0.3)
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(good - {r.doc_id for r in stages[1]}) <= 0.02 * len(good)


def test_lines(stages):
    left = plain_dedup([(r.doc_id, r.text) for r in stages[1]])
    assert {r.doc_id: r.text for r in stages[2]} == {i: t for (i, _), (t, _) in left.items()}
    assert all(r.n_chars == len(r.text) for r in stages[2])


def test_near_copies(stages):
    rows = [(r.doc_id, r.text) for r in stages[2]]
    _, least, _ = plain_groups(rows)
    assert sorted(r.doc_id for r in stages[3]) == sorted(set(least.values()))
    assert {tuple(r) for r in stages[3]} <= {tuple(r) for r in stages[2]}


def test_repeats(stages):
    want = {i: (n, sha) for i, _, n, _, sha in plain_removal([(r.doc_id, r.text) for r in stages[3]])}
    before = {r.doc_id: r.text for r in stages[3]}
    assert len(stages[4]) == len(before)
    for r in stages[4]:
        n, sha = want[str(r.doc_id)]
        assert (r.text == before[r.doc_id]) if not n else r.n_chars == len(r.text)
        if before[r.doc_id].isascii():
            assert hashlib.sha256(r.text.encode()).hexdigest() == sha


def test_packing(stages):
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    lengths = [(r.doc_id, len(library.encode(r.text, add_special_tokens=False).ids)) for r in stages[4]]
    check_packing(stages[5], lengths)


def test_run_is_its_stages(spark, sf_dir, stages):
    assert as_rows(corpus_pipeline.run(spark, sf_dir).selectExpr("shard", "bin", "capacity", "used", "to_json(struct(doc_ids, starts, lengths))")) == as_rows(
        spark.createDataFrame(stages[5]).selectExpr("shard", "bin", "capacity", "used", "to_json(struct(doc_ids, starts, lengths))"))


def test_odd_rows(spark, sf_dir, odd_texts):
    rows = [(i, t, None, "s", None, "x") for i, t in enumerate(odd_texts)] + [(None, "null id", "en", None, 3, None), (3, " ", "en", "s", 1, "y"), (3, " ", "en", "s", 1, "y")]
    kind = "doc_id long, text string, lang string, source string, n_chars long, score string"
    for docs in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        for _, run in corpus_pipeline.STAGES[:-1]:
            out = run(spark, docs, sf_dir)
            assert out.columns == docs.columns
            out.count()
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() > 0) == (docs.count() > 0)

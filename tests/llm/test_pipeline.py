"""The stages against plain versions on a small corpus."""

import numpy as np

import corpus_pipeline
from maskwright.llm import langid
from maskwright.llm.queries import tokenizer_path
from tests.llm.conftest import AWKWARD
from tests.llm.test_documents_ops import brute_align, brute_lines, brute_near


def test_pipeline(spark, corpus, tmp_path):
    import re

    from tokenizers import Tokenizer

    frame, bench, docs, item = corpus
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = [(i, t) for i, t, _ in docs if any(c.isalpha() for c in t)]
    model = langid.train(langid.learnable(frame))
    kept = [(i, t) for i, t in kept if model.predict(t)[1] >= corpus_pipeline.MIN_LANGUAGE_SCORE]
    kept = [(i, t) for i, _, _, t in brute_lines(kept, 10)]
    small = {i for i, _, c in brute_near(kept, 80) if i == c}
    kept = [(i, t) for i, t in kept if i in small]
    split = lambda t: re.findall(r"[^\W_]+", t.lower())
    kept = [(i, t) for i, t in kept if brute_align(split(item), split(t)) < len(split(item))]
    plain = Tokenizer.from_file(tokenizer_path())
    want = {i: len(plain.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept}
    got = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want and np.all([r.offset + r.length <= 4096 for r in rows])


def test_stages_on_awkward_tables(spark, awkward, nothing, corpus, tmp_path):
    """Nulls in all columns, repeated and null ids, clashing names, empty tables."""
    corpus[1].write.parquet(str(tmp_path / "benchmark.parquet"))
    odd = awkward.unionByName(spark.createDataFrame([(None, "no id at all but some words in it, really", None, None, None, None, None)], awkward.schema))
    docs, empty = odd, nothing
    for name, stage in corpus_pipeline.STAGES:
        docs, empty = stage(spark, docs, str(tmp_path)), stage(spark, empty, str(tmp_path))
        assert empty.count() == 0, name
    got = {(r.doc_id, r.length) for r in docs.collect()}
    assert {i for i, _ in got} <= {i for i, _ in AWKWARD} and None in {i for i, _ in got}
    kept = corpus_pipeline.near_duplicates(spark, odd, str(tmp_path))
    assert kept.columns == odd.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 7, 8, 8, 9, 10]


def test_text_of_no_learnt_language_goes(spark, corpus):
    import random

    rnd = random.Random(1)
    frame, _, docs, _ = corpus
    greek = [(1000 + k, " ".join("".join(chr(rnd.randint(0x3B1, 0x3C9)) for _ in range(rnd.randint(2, 9))) for _ in range(60)), None, None, None) for k in range(40)]
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, frame.unionByName(spark.createDataFrame(greek, frame.schema)), "").collect()}
    assert len(kept & set(range(220))) == 220 and len([i for i in kept if i >= 1000]) <= 10


def test_stages_keep_the_columns(spark, corpus, tmp_path):
    frame, bench, _, _ = corpus
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame, str(tmp_path)).columns == frame.columns, name

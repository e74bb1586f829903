"""The pipeline against the operators' reports, stage by stage, and its registration."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as registry
import corpus_pipeline
from starloom.llm.common import table
from starloom.llm.exact_dedup import exact_duplicates
from starloom.llm.mixing import mix_report
from starloom.llm.quality import quality_measures
from starloom.llm.queries import QUERIES
from starloom.llm.simhash import simhash_groups

SMALL = "/root/testdata/sf0.001"


def test_registered():
    names = registry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in registry.oracle_sql()


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first stage and after each of the first four."""
    docs = [table(spark, SMALL, "documents").cache()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs.append(stage(spark, docs[-1], SMALL).cache())
    return docs


def ids(docs):
    return Counter(r.doc_id for r in docs.select("doc_id").collect())


def test_columns(stages):
    assert all(docs.dtypes == stages[0].dtypes for docs in stages)


def test_stages_take_effect(stages):
    reports = [
        {r.doc_id for r in quality_measures(stages[0], nearest=True).collect() if r.kept},
        {r.doc_id for r in exact_duplicates(stages[1]).collect() if r.kept},
        {r.doc_id for r in simhash_groups(stages[2]).collect() if r.doc_id == r.component_id},
    ]
    for before, after, kept in zip(stages, stages[1:], reports, strict=False):
        assert ids(after) == Counter(kept)
        assert sum(ids(before).values()) >= len(kept)
    times = {r.doc_id: r.taken // r.size for r in mix_report(stages[3]).collect()}
    assert ids(stages[4]) == Counter({i: n for i, n in times.items() if n})


def test_run_packs_what_the_mix_holds(spark, stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r.text for r in stages[4].collect()]
    encoded = tokenizer.encode_batch(texts, add_special_tokens=False)
    expected = Counter(t for e in encoded for t in [*e.ids, 1])
    rows = corpus_pipeline.run(spark, SMALL).collect()
    found = Counter(t for r in rows for t in np.frombuffer(r.ids, "<u4").tolist())
    assert found == expected
    assert Counter(r.doc_id for r in rows if r.start == 0) == ids(stages[4])


def test_odd_rows_pass_all_stages(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string"
    words = " ".join(f"term{i}" for i in range(40))
    rows = [
        (None, None, None, None, None, None),
        (1, "", "en", "a", 0, "x"),
        (2, words, "en", None, 1, "x"),
        (2, words, "en", None, 1, "x"),
        (3, words.upper(), None, "a", 1, "x"),
        (4, " ".join(f"long{i}" for i in range(30_000)), "en", "a", 1, "x"),
    ]
    for name, data in (("odd", rows), ("none", [])):
        path = f"{tmp_path}/{name}"
        spark.createDataFrame(data, schema).write.parquet(f"{path}/documents.parquet")
        packed = corpus_pipeline.run(spark, path).collect()
        assert {r.doc_id for r in packed} <= {3, 4}
        assert bool(packed) == bool(data)

"""The pipeline, stage by stage, against brute force on each stage's own input."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkcast.llm import quality, simhash
from sparkcast.llm.shared import saved
from tests.conftest import SF_SMALL
from tests.llm.test_documents import lines_brute, simhash_brute, words

NAMES = ["quality rules", "line dedup", "SimHash near-dedup", "mixing sources to target weights", "packing"]


def test_stages_and_entry():
    import __spark_entry__ as entry

    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert set(entry.oracle_sql()) <= names


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) of each stage on the smallest table."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = []
    for _, stage in corpus_pipeline.STAGES:
        after = saved(stage(spark, docs, SF_SMALL), "test-stage")
        out.append((docs, after))
        docs = after
    return out


def test_columns_stay(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns
        assert [f.dataType for f in after.schema] == [f.dataType for f in before.schema]


def test_quality_stage(stages):
    before, after = stages[0]
    kept = quality.quality_rules(before).where("kept")
    assert Counter(r.doc_id for r in after.collect()) == Counter(r.doc_id for r in kept.collect())


def test_line_stage(stages):
    before, after = stages[1]
    rows = [r.asDict() for r in before.select("doc_id", "text", F.xxhash64("text").alias("text_key")).collect()]
    gone = {(i, n) for (i, n, _, _, kept) in lines_brute(rows) if not kept}
    want = {
        r["doc_id"]: "\n".join(x for n, x in enumerate(r["text"].split("\n")) if (r["doc_id"], n) not in gone)
        for r in rows
    }
    got = after.collect()
    assert {r.doc_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_simhash_stage(stages):
    before, after = stages[2]
    _, group, least = simhash_brute([r.asDict() for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted(least.values())
    assert simhash.simhash_components(after).groupBy("component_id").count().where("count > 1").count() == 0


def test_mix_stage(stages):
    before, after = stages[3]
    held, taken = Counter(), Counter()
    for r in before.collect():
        held[r.source] += len(words(r.text))
    for r in after.collect():
        taken[r.source] += len(words(r.text))
    assert sum(taken.values()) == pytest.approx(1.5 * sum(held.values()), abs=len(held))
    assert all(taken[s] <= 2 * held[s] for s in held)


def test_packing_stage(stages):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    before, after = stages[4]
    total = sum(
        len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in before.collect()
    )
    rows = after.toPandas()
    assert rows.length.sum() == total
    used = rows.groupby("sequence_id").length.sum()
    assert (used <= 2048).all() and ((used & (used - 1)) == 0).all()
    at = rows.sort_values(["sequence_id", "offset"])
    assert (at.offset == at.groupby("sequence_id").length.cumsum() - at.length).all()
    assert np.issubdtype(rows.ids_crc32.dtype, np.integer)


def test_run_on_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("false")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

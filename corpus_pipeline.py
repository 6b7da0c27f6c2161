"""A training corpus from ``documents``: stages applied one after another.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from sparkcast.llm import linedup, mix, packing, quality, simhash
from sparkcast.llm.shared import read_table, saved


def quality_stage(spark, docs, sf_dir):
    """Documents that the quality rules reject go."""
    return quality.quality_filter(docs)


def line_stage(spark, docs, sf_dir):
    """Lines that repeat an earlier one, or nearly do, go."""
    return linedup.dedup_lines(docs)


def simhash_stage(spark, docs, sf_dir):
    """One document of each near-duplicate group stays."""
    return simhash.simhash_dedup(docs)


def mix_stage(spark, docs, sf_dir):
    """Sources are brought to their target weights, in training order."""
    return mix.mixed_documents(docs)


def packing_stage(spark, docs, sf_dir):
    """Tokenized pieces with their places in training sequences."""
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.with_checksum(pieces)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", simhash_stage),
    ("mixing sources to target weights", mix_stage),
    ("packing", packing_stage),
]

#: Similarity links and tokenizers have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        if i:
            docs = saved(docs, "pipeline-stage")
        docs = stage(spark, docs, sf_dir)
    return docs

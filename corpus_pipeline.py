"""Corpus pipeline: toxicity, quality rules, near-duplicates, repeated strings, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the
last return rows with the columns of `documents`; the last returns the pieces
of the packed sequences. Labels come from `sf_dir`; everything else a stage
needs it learns from the rows that the stage before it kept.

In every stage a null text reads as empty, an empty table gives an empty table,
and further columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from teampulse.llm import iforest, packing, simhash, suffix, toxicity
from teampulse.llm.frames import small_batches, stored, table

#: No SQL: the stages hash shingles by XXH64, fit models and tokenise. Tested against brute force instead.
ORACLE_SQL = None


def toxicity_stage(spark, docs, sf_dir):
    """Operator 8: rows that score at or over the threshold go. Judged row by row: repeated rows and null ids fare as
    their texts do; without labels every row stays."""
    small_batches(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def quality_stage(spark, docs, sf_dir):
    """Operator 1: rows that fail the base rule or the forest go. Judged row by row: repeated rows and null ids fare as
    their texts do; empty texts fail the base rule."""
    small_batches(spark)
    return iforest.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark, docs, sf_dir):
    """Operator 10 (4-word shingles, 4 bits): one row of each class stays, that with the smallest id, of equal ids that
    with the smallest hash of its text, of equal rows one; where a class has no id the hash decides."""
    small_batches(spark)
    return simhash.keep_first(docs, k=4, max_bits=4)


def repeated_string_stage(spark, docs, sf_dir):
    """Operator 5: bytes of strings of 100 bytes that also start earlier go; every row stays, null texts stay null. Null
    ids come before all others; rows that repeat an id and a text count as one document."""
    small_batches(spark)
    return suffix.without_repeats(docs)


def packing_stage(spark, docs, sf_dir):
    """Operator 9: pieces of sequences of at most 2048 ids. Repeated rows and null ids are packed each; an empty text has
    one piece with the end mark."""
    small_batches(spark)
    return packing.packed(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality rules", quality_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("suffix-array dedup", repeated_string_stage),
    ("packing", packing_stage),
]


def run(spark, sf_dir):
    """The pieces of all documents that stay; each stage but the last is written below spark.checkpoint.dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

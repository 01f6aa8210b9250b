"""Exact duplicates against a plain grouping of the texts."""

from collections import defaultdict
from hashlib import sha256

from llm_cases import LOWER, TEXTS, documents, empty
from pyspark.sql import functions as F

from teampulse.llm import exact, queries

MORE = [(20, "SHORT Text."), (21, "short text."), (22, "Ä short"), (23, "ä short"), (24, ""), (25, "one"), (25, "one"),
        (None, "one"), (None, "lonely"), (None, "lonely"), (25, "another text of id 25")]


def plain(rows, keep=max):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        best = keep((i for i in ids if i is not None), default=None)
        out += [(i, best, len(ids), sha256(text.encode()).hexdigest()) for i in ids]
    return out


def got(frame):
    return [tuple(r) for r in frame.select("id", "keep_id", "group_size", "text_sha256").collect()]


def ordered(rows):
    return sorted(rows, key=str)


def test_equals_plain_grouping(spark):
    docs = documents(spark, more=MORE)
    for keep, best in (("largest", max), ("smallest", min)):
        out = exact.exact_duplicates(docs, keep=keep).cache()
        assert ordered(got(out)) == ordered(plain([*TEXTS, *MORE], best))
        stays = out.where("kept").collect()
        assert len(stays) == len({r.text_sha256 for r in stays}) == out.select("text_sha256").distinct().count()
        assert all(r.id == r.keep_id for r in stays)


def test_colliding_hashes_are_told_apart_by_bytes(spark):
    docs = documents(spark, more=MORE)
    weak = exact.exact_duplicates(docs, keep="largest", digest=lambda t: F.substring(F.md5(t), 1, 1))
    assert ordered(got(weak)) == ordered(plain([*TEXTS, *MORE]))


def test_hot_and_cold_classes(spark):
    """One class with a third of all rows and many small ones: both ways of meeting a class are taken."""
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i // 2}") for i in range(6000)]
    out = exact.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), keep="largest")
    assert ordered(got(out)) == ordered(plain(rows))
    assert out.where("kept").count() == len({t for _, t in rows})


def test_whole_rows_stay_with_their_columns(spark):
    docs = documents(spark, more=MORE)
    out = exact.deduplicated(docs)
    assert out.columns == docs.columns
    assert out.count() == len({(t or "").translate(LOWER) for _, t in [*TEXTS, *MORE]})
    assert sorted(r.doc_id for r in out.where("text = 'one'").collect()) == [25]


def test_empty_table(spark):
    assert exact.exact_duplicates(empty(spark)).count() == 0


def test_query_columns_and_no_python(spark):
    df = queries.op11_exact_dedup(spark, "/root/testdata/sf0.001")
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

import numpy as np

import corpus_pipeline
import llm_cases as C
from pyspark.sql import functions as F
from test_iforest import _corpus

from teampulse.llm import graph, queries, simhash
from teampulse.llm.frames import looked_up, stored


def test_stages_in_order_and_take_effect(spark, tmp_path):
    rows, marks = _corpus(200)
    rng = np.random.default_rng(0)
    toxic = [(5000 + i, t + " vilescum moronic " + str(rng.integers(9))) for i, (_, t) in enumerate(rows[1:160:4])]
    marks += [(i, 1, 1) for i, _ in toxic]
    docs = C.documents(spark, [*rows, *toxic, (9000, rows[1][1]), (9001, rows[2][1] + " tail"), (9002, None), (9003, "")])
    C.labels(spark, marks).write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "simhash near-dedup", "suffix-array dedup", "packing"]
    ids = [{r.doc_id for r in docs.collect()}]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        ids.append({r.doc_id for r in docs.select("doc_id").distinct().collect()})
    bad = {i for i, q, _ in marks if not q}
    assert not ids[1] & {i for i, _ in toxic} and len(ids[0] - ids[1] - {i for i, _ in toxic}) == 0
    assert not ids[2] & bad and not ids[2] & {9002, 9003}
    assert 9000 not in ids[3] and rows[1][0] in ids[3]
    assert ids[4] == ids[3] == ids[5]
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{tmp_path}/3").collect()}
    if 9001 in ids[3]:
        assert len(text[9001]) < 60
    whole = corpus_pipeline.run(spark, str(tmp_path))
    cols = [c for c in whole.columns if c not in ("sequence_id", "offset")]
    key = lambda df: sorted({r.doc_id: r.doc_tokens for r in df.select(cols).collect()}.items())
    assert key(whole) == key(docs)


def test_near_duplicates_leave_one_row_of_each_class(spark):
    far = [(i, " ".join(f"t{i}w{k}" for k in range(40))) for i in range(5)]
    rows = [(1, C.PARAGRAPH)] * 3 + [(2, C.PARAGRAPH), (None, C.PARAGRAPH), (None, "no id " + C.LONG), (None, "no id " + C.LONG)]
    rows += [(100 + i, t) for i, t in far] + [(100, far[1][1]), (104, far[4][1]), (104, far[4][1])]
    docs = C.documents(spark, rows).repartition(4)
    out = simhash.keep_first(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    want = [(1, C.PARAGRAPH), (None, "no id " + C.LONG), (100, far[0][1]), (100, far[1][1]), *((100 + i, far[i][1]) for i in (2, 3, 4))]
    assert got == sorted(want, key=str)


def test_stages_take_repeats_null_ids_and_empty_tables(spark, tmp_path):
    rows = [*C.TEXTS, *C.TEXTS[:2], (None, C.PARAGRAPH + "more"), (None, None), (None, C.PARAGRAPH + "more")]
    C.labels(spark, [(0, 1, 0), (10, 0, 1), (None, 1, 0), (7, None, None)]).write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (C.documents(spark, rows), C.empty(spark)):
        n = docs.count()
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            kept = out.count()
            if k < 4:
                assert out.columns == docs.columns and kept <= n, name
                assert out.exceptAll(docs.select(*out.columns)).count() == 0 or name == "suffix-array dedup"
            docs, n = stored(out, "stage"), kept


def test_a_hub_is_spread_and_keeps_its_component(spark):
    """A star with most edges, a chain and pairs; no task of a round's joins reads the whole hub."""
    edges = [(0, i) for i in range(1, 3000)] + [(5000 + i, 5001 + i) for i in range(40)] + [(9000 + 2 * i, 9001 + 2 * i) for i in range(300)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in graph.connected_components(df).collect()}
    assert got == {i: 0 for i in range(3000)} | {5000 + i: 5000 for i in range(41)} | {9000 + i: 9000 + i - i % 2 for i in range(600)}
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        low = df.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("size"))
        met = looked_up(df, low, ["a"], "size")
        plan = met._jdf.queryExecution().executedPlan().toString()
        most = met.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "_salt" in plan and most < len(edges) / 4


def test_registered_names():
    names = list(queries.queries())
    assert "pipeline" in names and [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert corpus_pipeline.ORACLE_SQL is None and set(queries.oracle_sql()) <= set(names)

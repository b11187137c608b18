from pyspark.sql import functions as F

import corpus_pipeline as C
from riskloom.llm import packing, simhash
from riskloom.llm.queries import op3_quality, op9_toxicity

SF = "/root/testdata/sf0.01"


def test_stages_follow_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["toxicity", "quality", "simhash", "packing"]
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    clean = C.toxicity_stage(spark, docs, SF).cache()
    assert clean.columns == docs.columns
    assert ids(clean) == ids(op9_toxicity(spark, SF).where("predicted = 0"))
    good = C.quality_stage(spark, clean, SF).cache()
    assert ids(good) == ids(clean) & ids(op3_quality(spark, SF).where("predicted = 1"))
    one = C.simhash_stage(spark, good, SF).cache()
    groups = simhash.simhash_groups(good)
    assert one.count() == groups.select("component_id").distinct().count() and ids(one) == ids(groups.where("doc_id = component_id"))
    bins = C.packing_stage(spark, one, SF).collect()
    words = {r["doc_id"]: len(r["text"].encode().split()) for r in one.collect()}
    got = {}
    for b in bins:
        for i in b["items"]:
            got[i["id"]] = got.get(i["id"], 0) + i["length"]
    assert got == words and all(b["capacity"] in packing.CAPACITIES for b in bins)
    ran = C.run(spark, SF)
    assert sorted(map(str, ran.collect())) == sorted(map(str, bins))


def test_odd_rows(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (3, None), (None, "x y z w"), (None, None)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = C.simhash_stage(spark, docs.withColumn("component_id", F.lit("clash")), str(tmp_path))
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(str, [(1, "a b c d"), (3, None), (None, "x y z w"), (None, None)]))
    assert C.run(spark, str(tmp_path)).count() > 0


def test_rows_are_rejected_by_row(spark, tmp_path, monkeypatch):
    for name, schema in (("documents", "doc_id long, text string"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    rows = lambda df: sorted(map(str, ((r["doc_id"], r["text"]) for r in df.collect())))
    frame = lambda x: spark.createDataFrame(x, "doc_id long, text string")
    x, y = "one two three four five six", "quite another text that stands alone here"
    # different texts under one id
    assert rows(C.simhash_stage(spark, frame([(5, x), (5, y), (2, y)]), str(tmp_path))) == sorted(map(str, [(5, x), (2, y)]))
    # copies under null ids
    assert rows(C.simhash_stage(spark, frame([(None, x), (None, x), (None, y), (7, y)]), str(tmp_path))) == sorted(map(str, [(None, x), (7, y)]))
    bad = lambda good, low: lambda docs, model, id_col="doc_id": docs.select(id_col, F.when(F.col("text") == y, low).otherwise(good).alias("score"))
    for stage, fit, score, values in ((C.toxicity_stage, "fit_toxicity", "toxicity_scores", (0.0, 1.0)), (C.quality_stage, "fit_quality", "quality_scores", (1.0, 0.0))):
        monkeypatch.setattr(C, fit, lambda *a: None)
        monkeypatch.setattr(C, score, bad(*values))
        assert rows(stage(spark, frame([(5, x), (5, y), (None, y), (None, x), (6, y)]), str(tmp_path))) == sorted(map(str, [(5, x), (None, x)]))


def test_odd_columns_texts_and_empty_tables(spark, tmp_path):
    """Columns that clash with the stages' own, null and very long texts, repeated rows: every stage keeps the columns; empty tables stay empty."""
    from tempfile import mkdtemp
    for name, schema in (("documents", "doc_id long, text string"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(1, "a b c d", "k1"), (1, "a b c d", "k2"), (None, None, "k3"), (None, None, "k4"), (None, "", "k5"), (4, None, "k6"), (5, long, "k7"), (6, long + " w", "k8")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _text_key string").withColumn("score", F.lit(9)).withColumn("k", F.lit("x")).withColumn("of", F.lit(1))
    docs = spark.read.parquet((lambda p: (docs.write.parquet(p), p)[1])(mkdtemp(dir=str(tmp_path)) + "/d"))
    for stage in (C.toxicity_stage, C.quality_stage):
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns and kept.count() in (0, len(rows))
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    kept = C.simhash_stage(spark, docs, str(tmp_path))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["_text_key"]) for r in kept.collect())
    assert kept.columns == docs.columns
    # one of the equal rows 1; of the texts without words that with the id; both rows with neither id nor text; one of the long texts
    assert [g[:2] for g in got] == [(False, 1), (False, 4), (False, 5), (True, 0), (True, 0)] and [g[2] for g in got][3:] == ["k3", "k4"]
    assert C.simhash_stage(spark, docs.limit(0), str(tmp_path)).count() == 0 and C.packing_stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_documents_are_written_once_a_stage(spark, tmp_path, monkeypatch):
    """No stage writes a table with the text but its result."""
    written = []
    from riskloom.llm import simhash as S
    for module in (C, S):
        real = module.write_table
        monkeypatch.setattr(module, "write_table", lambda df, name, _real=real: (written.append((name, df.columns)), _real(df, name))[1])
    C.run(spark, "/root/testdata/sf0.001")
    assert [n for n, c in written if "text" in c] == ["pipeline-toxicity", "pipeline-quality", "pipeline-simhash"]

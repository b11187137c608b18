import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import quality as Q
from riskloom.llm import toxicity as X
from riskloom.llm.queries import op3_quality, op9_toxicity

SF01 = "/root/testdata/sf0.1"


def auc(df):
    rank, pos = df["score"].rank(), df["y"] == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


@pytest.mark.parametrize("query,label,least", [(op3_quality, "quality", 0.98), (op9_toxicity, "toxic", 0.97)])
def test_held_out_accuracy(spark, query, label, least):
    out = query(spark, SF01)
    assert out.count() == spark.read.parquet(f"{SF01}/documents.parquet").count()
    scored = out.join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").withColumn("y", F.col(label)).toPandas()
    held = scored[scored["held_out"]]
    assert auc(held) >= least and (held["predicted"] == held["y"]).mean() >= 0.97
    assert scored["score"].between(0, 1).all()


def docs_and_labels(spark):
    rows = [(i, ("you are an idiot and scum %d" if i % 2 else "a fine day in town %d") % i) for i in range(200)]
    rows += [(None, "no id"), (900, None), (901, ""), (902, "word " * 60000), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("y", F.lit(1)).withColumn("part", F.lit(0))
    labels = spark.createDataFrame([(i, 1 - i % 2, i % 2) for i in range(200)] + [(None, 1, 1), (5, None, None), (6, 1, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_odd_rows(spark):
    docs, labels = docs_and_labels(spark)
    for scores in (Q.quality_scores(docs, Q.fit_quality(docs, labels)), X.toxicity_scores(docs, X.fit_toxicity(docs, labels, trees=5))):
        got = scores.collect()
        assert len(got) == docs.count()
        by = {r["doc_id"]: r["score"] for r in got}
        assert by[900] == by[901] and all(0 <= s <= 1 for s in by.values())
    none = labels.limit(0)
    assert Q.quality_scores(docs, Q.fit_quality(docs, none)).count() == docs.count()
    assert {r["score"] for r in X.toxicity_scores(docs, X.fit_toxicity(docs, none)).collect()} == {0.0}
    assert Q.quality_scores(docs.limit(0), np.zeros(2**18 + 1)).count() == 0


def features(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return dict(zip(X.NAMES, X.dense_features(raw, np.array([0, len(raw)]), X.EMPTY)[0]))


def test_dense_features():
    f = features("You are an Idiot, LOSER!! b1rd")
    assert f["fixed"] == pytest.approx(2 / 6) and f["fixed_near"] == pytest.approx(2 / 6) and f["second"] == pytest.approx(1 / 6)
    assert f["caps_words"] == pytest.approx(1 / 6) and f["mixed"] == pytest.approx(1 / 6) and f["exclaims"] == pytest.approx(2 / 30)
    assert features("1d1ot and i.d.i.o.t and st*upid")["hidden"] > 0 and features("idiot and town")["hidden"] == 0
    assert not any(features("").values())


def test_ftrl_equals_plain_loops():
    rng = np.random.default_rng(0)
    rows = [(np.append(rng.choice(16, 4, replace=False), 16), np.append(rng.random(4), 1.0), int(rng.integers(2))) for _ in range(50)]
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 1e-4
    z, n = [0.0] * 17, [0.0] * 17
    weight = lambda i: 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((beta + n[i] ** 0.5) / alpha + l2)
    for _ in range(2):
        for idx, x, y in rows:
            w = {int(i): weight(int(i)) for i in idx}
            p = 1 / (1 + np.exp(-sum(w[int(i)] * v for i, v in zip(idx, x))))
            for i, v in zip(map(int, idx), x):
                g = (p - y) * v
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha * w[i]
                n[i] += g * g
    assert np.allclose(Q.ftrl(rows, 4, 2, alpha, beta, l1, l2), [weight(i) for i in range(17)])


def test_features_are_shares_of_plain_ngrams():
    text = "The cat, the  cat!! 12"
    raw = np.frombuffer(text.encode(), np.uint8)
    which, place, weight = Q.features(raw, np.array([0, len(raw)]), 18)
    assert (which == 0).all() and weight.sum() == pytest.approx(Q.FAMILIES)
    assert len(place) == 5 + 4 + 7 + 6 + 5  # words, pairs, shapes of 1, 2, 3 tokens


def test_label_sample_is_the_smallest_hashes(spark):
    """The cut by hash keeps the sample what ordering all labelled rows gives."""
    from riskloom.llm.common import hash_cut, held_out, label_sample
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    labels = spark.range(6000).repartition(8).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("toxic"))
    for most in (50, 700, 10_000):
        got, n = label_sample(docs, labels, "toxic", most)
        want = [r[0] for r in labels.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id").collect()]
        assert sorted(r["doc_id"] for r in got.collect()) == sorted(want) and n == len(want)
    passed = labels.where(F.xxhash64("doc_id") <= hash_cut(6000, 500)).count()
    assert 500 < passed < 1500
    assert label_sample(docs, labels.limit(0), "toxic", 10)[1] == 0

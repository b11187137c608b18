import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import multi_index as M
from riskloom.llm import projection_dedup as P


def clustered(n=600, d=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    x[50:120] = x[50] + 0.08 * rng.standard_normal((70, d))     # one large near group
    x[200:230] = x[200]                                        # exact copies
    for i in range(300, 360, 2):
        x[i + 1] = x[i] + 0.35 * rng.standard_normal(d)          # pairs around the threshold
    return x.astype(np.float32)


def brute_links(x, t=0.9):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= t
    np.fill_diagonal(near, False)
    comp = np.arange(len(x))
    while True:
        new = np.array([min(comp[i], comp[near[i]].min(initial=comp[i])) for i in range(len(x))])
        if (new == comp).all():
            return near.sum(1), comp
        comp = new


BAD = [(9001, None), (9002, []), (9003, [0.0] * 16), (9004, [float("nan")] + [1.0] * 15), (9005, [None] + [1.0] * 15), (9006, [float("inf")] * 16), (None, [1.0] * 16), (9007, [1.0, 2.0])]


@pytest.mark.parametrize("window,chunk,block", [(512, 2048, 4096), (16, 20, 64)])
def test_links_equal_brute_force(spark, window, chunk, block):
    x = clustered()
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows + rows[:3] + BAD, "vec_id long, embedding array<float>").withColumn("cid", F.lit("clash"))
    got = P.near_duplicate_vectors(df, window=window, chunk=chunk, block=block, recall=0.9999).collect()
    assert len(got) == len(rows) + 3 + len(BAD)
    n, comp = brute_links(x)
    by = {r["vec_id"]: r for r in got}
    for i in range(len(x)):
        assert (by[i]["n_links"], by[i]["component_id"], by[i]["kept"]) == (n[i], comp[i], comp[i] == i)
    for i, _ in BAD:
        assert (by[i]["n_links"], by[i]["component_id"], by[i]["kept"]) == (0, i, True)


def test_pairs_empty_and_passes(spark):
    assert P.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert P.passes_needed(100, 0.9, 512, 0.998) == 1
    assert P.passes_needed(10**6, 0.9, 512, 0.998) > P.passes_needed(10**5, 0.9, 512, 0.998)


def off_centre(n, topic, cosine=0.69, pairs=400, d=64, seed=3):
    """Vectors of which the share ``topic`` has one direction in common, with isolated pairs at 0.9005 planted among those."""
    rng = np.random.default_rng(seed)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    x = unit(rng.standard_normal((n, d)))
    m, k = unit(rng.standard_normal(d)), int(n * topic)
    x[:k] = unit(np.sqrt(cosine) * m + np.sqrt(1 - cosine) * x[:k])
    first, second = x[:pairs], x[pairs: 2 * pairs]
    # partners in the direction of another row of the topic, so that they have the common part too
    across = unit(second - (first * second).sum(1, keepdims=True) * first)
    x[pairs: 2 * pairs] = 0.9005 * first + np.sqrt(1 - 0.9005 ** 2) * across
    return x, pairs


@pytest.mark.parametrize("topic", [1.0, 1 / 3])
def test_pairs_off_the_centre_meet(spark, topic):
    """At the parameters of the query; with passes from the row count alone 7 of the 400 pairs of the dense third stayed apart."""
    x, pairs = off_centre(20_000, topic)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    component = {r["vec_id"]: r["component_id"] for r in P.near_duplicate_vectors(df).collect()}
    assert sum(component[i] != component[i + pairs] for i in range(pairs)) <= 2


def test_index_holds_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 256, (500, 8), dtype=np.uint8)
    index = M.MultiIndex(codes)
    for r in (0, 3, 8, 17, 24, 40, 64):
        for q in codes[:20]:
            assert index.within(q, r).tolist() == np.flatnonzero(M.hamming(codes, q) <= r).tolist()


def brute_nearest(rows, ask, k=10):
    """Per query row: (query_id, [(score, id)] of its k nearest rows of the same length but itself)."""
    out = []
    for i, (q, v) in enumerate(rows):
        if q is None or not ask(q):
            continue
        d = sorted((float(np.sqrt(((np.array(w, float) - np.array(v, float)) ** 2).sum())), c) for j, (c, w) in enumerate(rows) if j != i and c is not None and len(w) == len(v))
        out.append((q, d[:k]))
    return out


def test_all_lengths_repeated_ids_at_the_parameters_of_the_query(spark, tmp_path):
    """Two lengths, repeated rows and repeated ids with other vectors: every valid row asks and answers; recall at the query's own parameters."""
    x = clustered(1500)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += rows[:3] + [(100, [float(v) for v in x[7]]), (100, [float(v) for v in x[8]])]
    rows += [(200 + i, [float(i % 7), float(i % 5) + 1]) for i in range(0, 300, 20)] + [(300, [1.0])]      # ids of the first length too
    df = spark.createDataFrame(rows + BAD + [(None, [1.0, 2.0])], "vec_id long, embedding array<float>").withColumn("row", F.lit("clash")).withColumn("rank", F.lit(0))
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    from riskloom.llm.queries import op6_multi_index
    got = {}
    for r in op6_multi_index(spark, str(tmp_path)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    want = brute_nearest([(i, np.array(v, np.float32).astype(float)) for i, v in rows], lambda q: q % 100 == 0)
    assert sorted(got) == sorted({q for q, d in want if d})
    hits = total = 0
    for q in got:
        asked = [d for qq, d in want if qq == q]
        assert sorted(r for r, _, _ in got[q]) == sorted(r for d in asked for r in range(1, len(d) + 1))
        found = [(round(s, 9), v) for _, s, v in got[q]]
        for d in asked:
            for s, v in d:
                total += 1
                if (round(s, 9), v) in found:
                    found.remove((round(s, 9), v))
                    hits += 1
    assert hits / total >= 0.9


def test_sample_on_the_driver_is_bounded(spark):
    """What passes the hash cut is about twice the sample, not a sample per partition."""
    n, sample = 20_000, 500
    rows = spark.range(n).repartition(16).select("id", F.monotonically_increasing_id().alias("row"))
    cut = 2.0 * sample / n
    assert rows.where(F.abs(F.xxhash64("id", "row").cast("double")) <= cut * 2.0 ** 63).count() < 3 * sample


def test_recall_and_exact_scores(spark):
    x = np.vstack([clustered(1200), clustered()[:2]])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows + BAD, "vec_id long, embedding array<float>").withColumn("query_id", F.lit(1))
    got = M.nearest(df, F.col("id") % 20 == 0, block=300, query_block=16, rotations=4).collect()
    x = x.astype(float)
    hits = total = 0
    for q in range(0, len(x), 20):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r for r, _, _ in mine] == list(range(1, 11))
        assert [(s, v) for _, v, s in mine] == sorted((s, v) for _, v, s in mine)
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        assert all(s == pytest.approx(d[v], abs=1e-12) for _, v, s in mine)
        want = set(np.lexsort((np.arange(len(x)), d))[:10])
        hits += len(want & {v for _, v, _ in mine})
        total += 10
    assert hits / total >= 0.9


def test_few_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (20, [1.0, 2.0]), (7, [3.0, 1.0]), (8, [1.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in M.nearest(df, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert [g[:3] for g in got] == [(0, 1, 20), (0, 2, 7), (20, 1, 0), (20, 2, 7)]
    assert M.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0
    assert M.nearest(df, F.col("id") == 5).count() == 0

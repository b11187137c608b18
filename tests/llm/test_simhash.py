import numpy as np
import xxhash
from pyspark.sql import functions as F

from riskloom.llm import simhash as S


def brute_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, radius=3):
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= radius and comp[j] < comp[i]:
                    comp[i], changed = comp[j], True
    ids = {}
    for c, (d, _) in zip(comp, rows):
        if d is not None:
            ids[c] = min(ids.get(c, d), d)
    return sorted(((d, f"{f:016x}", ids.get(c)) for c, f, (d, _) in zip(comp, fps, rows)), key=str)


def test_bit_sliced_equals_brute_force():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    vals = np.concatenate([base, base ^ np.uint64(5), base ^ np.uint64(1 << 40), base ^ np.uint64(0xF0), rng.integers(0, 1 << 63, 60, dtype=np.uint64)])
    bounds = [0, 1, 70, 71, 150, len(vals)]
    ends = np.concatenate([np.full(b - a, b) for a, b in zip(bounds, bounds[1:])])
    for r in (0, 1, 2, 3):
        got = {(int(i), int(j)) for a, b in S.bit_sliced_links(vals, ends, r, items=37) for i, j in zip(a, b)}
        want = {(i, j) for i in range(len(vals)) for j in range(i + 1, int(ends[i])) if int(vals[i] ^ vals[j]).bit_count() <= r}
        assert got == want


def test_groups_equal_brute_force(spark):
    words = [f"w{i}" for i in range(400)]
    long = " ".join(words)
    rows = [(5, long), (3, long), (9, long.replace("w100 ", "w100x ")), (11, "a b"), (12, "A  B"), (20, None), (21, " \n "), (7, "x y z Ü"), (None, long),
            (30, "one two three"), (30, "one two three"), (40, " ".join(words * 40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("id", F.lit(1))
    for split in (8192, 1):  # 1: every bucket of several goes through all levels
        out = S.simhash_groups(docs, split_above=split).select("doc_id", S.fingerprint_hex(F.col("fp")).alias("f"), "component_id")
        assert sorted((tuple(r) for r in out.collect()), key=str) == brute_components(rows)


def test_near_links_through_all_levels(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 1 << 62))
    fps = {base}
    while len(fps) < 200:
        v = base
        for b in rng.choice(64, 4, replace=False):
            v ^= 1 << int(b)
        fps.add(v)
    vals = sorted(fps)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in vals], "fp long")
    from riskloom.llm.components import connected_components
    def classes(split):
        root = {r["node"]: r["component"] for r in connected_components(S.fingerprint_links(df, 3, split)).collect()}
        out = {}
        for (v,) in df.collect():
            out.setdefault(root.get(v, v), set()).add(v)
        return sorted(map(sorted, out.values()))
    want = list(range(len(vals)))
    for _ in range(len(vals)):
        for i in range(len(vals)):
            for j in range(i):
                if (vals[i] ^ vals[j]).bit_count() <= 3:
                    want[i] = want[j] = min(want[i], want[j])
    assert len(classes(8192)) == len(classes(3)) == len(set(want))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.simhash_groups(docs).count() == 0

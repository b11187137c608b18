import random

from pyspark.sql import functions as F

from riskloom.llm import packing as P


def brute_best_fit(lengths, capacities, costs):
    """Joint policy, by plain search over all open bins."""
    bins, left = [], sum(lengths)
    for i, n in enumerate(lengths):
        open_ = [(b["room"], k) for k, b in enumerate(bins) if b["room"] >= n]
        if open_:
            b = bins[min(open_)[1]]
        else:
            c = min((c for c in capacities if c >= n), key=lambda c: (costs[c] / max(1, min(c, left)), c))
            b = {"room": c, "items": []}
            bins.append(b)
        b["items"].append(i)
        b["room"] -= n
        left -= n
    return [(min(c for c in capacities if c >= sum(lengths[i] for i in b["items"])), b["items"]) for b in bins]


def test_fit_equals_brute_force():
    rng = random.Random(4)
    caps = [8, 16, 40]
    costs = {c: P.default_cost(c) for c in caps}
    for _ in range(40):
        lengths = sorted((rng.randint(0, 40) for _ in range(rng.randint(0, 60))), reverse=True)
        assert P.fit(lengths, caps, costs) == brute_best_fit(lengths, caps, costs)
        total = lambda p: sum(costs[c] for c, _ in p)
        assert total(P.best_plan(lengths, caps, costs)) <= min(total(P.fit(lengths, caps, costs, c)) for c in caps)


def test_bins_hold_every_item_once(spark):
    rows = [(i, (i * 37) % 90) for i in range(300)] + [(7, 7 * 37 % 90)] * 5 + [(1000, 250), (1001, None), (None, 3), (1002, -4), (1003, 0)]
    df = spark.createDataFrame(rows, "doc_id long, length long").withColumn("piece", F.lit("clash")).withColumn("unit", F.lit(1))
    bins = P.pack_best_fit(df, capacities=(16, 50, 100), unit_items=64).collect()
    again = P.pack_best_fit(df.repartition(13), capacities=(16, 50, 100), unit_items=64).collect()
    assert sorted(map(str, bins)) == sorted(map(str, again))
    assert all(b["used"] == sum(i["length"] for i in b["items"]) <= b["capacity"] for b in bins)
    assert all(b["used"] > max([c for c in (16, 50, 100) if c < b["capacity"]], default=-1) for b in bins)
    got = sorted(((i["id"], i["piece"], i["length"]) for b in bins for i in b["items"]), key=str)
    want = []
    for i, n in rows:
        n = max(0, n or 0)
        want += [(i, p, min(100, n - 100 * p)) for p in range(max(1, -(-n // 100)))]
    assert got == sorted(want, key=str)
    assert P.pack_best_fit(df.limit(0)).count() == 0

import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.llm import queries
from riskloom.llm.line_dedup import apply_bitmaps, line_bitmaps

SCHEMA = "doc_id long, text string, d1 string, pos int, h1 long, lines string"
SPACE = " \t\n\x0b\x0c\r"


def key(line: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, min_docs=10, min_chars=1, keep_first=False):
    """(doc_id, lines, dropped, kept text) per row; a document is a distinct (id, text)."""
    docs, first = defaultdict(set), {}
    for i, t in rows:
        t = t or ""
        for pos, line in enumerate(t.split("\n")):
            k = key(line)
            if len(k) >= min_chars:
                docs[k].add((i, t))
                at = ((i is not None, i or 0), t, pos)
                first[k] = min(first.get(k, at), at)
    out = []
    for i, t in rows:
        t = t or ""
        lines = t.split("\n")
        kept = [line for pos, line in enumerate(lines)
                if len(key(line)) < min_chars or len(docs[key(line)]) < min_docs
                or (keep_first and first[key(line)] == ((i is not None, i or 0), t, pos))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 7, None, "y") for i, t in rows], SCHEMA)


def run(spark, rows, **how):
    docs = table(spark, rows)
    return sorted((tuple(r) for r in apply_bitmaps(docs, line_bitmaps(docs, **how)).collect()), key=str)


ODD = [(None, None), (1, ""), (2, "\n"), (3, "Menu\nStory one\n  MENU \t\nend"), (3, "Menu\nother text"), (4, "menu"), (4, "menu"),
       (None, "menu\nÉcole"), (None, "menu\nécole"), (5, "\x0bMenu\x0c\n\nMENU\nMENU"), (6, " menu"), (7, "ÉCOLE\nmenu"), (8, "\n\n\nlast\n")]


def test_odd_rows(spark):
    for how in ({"min_docs": 2}, {"min_docs": 3, "min_chars": 0}, {"min_docs": 6}, {"min_docs": 7}, {"min_docs": 2, "min_chars": 5}):
        assert run(spark, ODD, **how) == brute(ODD, **how), how


def test_empty_table(spark):
    assert run(spark, []) == []


def test_first_occurrences(spark):
    rows = [(i, t) for i, t in ODD if i != 3 and i is not None]    # ids with one text: ties in the id are ordered by hash
    assert run(spark, rows, min_docs=1, keep_first=True) == brute(rows, min_docs=1, keep_first=True)
    assert run(spark, rows, min_docs=3, keep_first=True) == brute(rows, min_docs=3, keep_first=True)


def test_long_text_and_hot_line(spark):
    rows = [(i, "hot\n" * 400 + f"own {i}\nHOT ") for i in range(400)] + [(1000, "\n".join(f"line {j % 70_000}" for j in range(150_000)) + "\nhot")]
    assert run(spark, rows) == brute(rows)
    first = line_first_partitions(spark, rows)
    assert first > 2        # the hot line is spread over ranges


def line_first_partitions(spark, rows) -> int:
    from riskloom.llm.line_dedup import first_lines, line_hashes
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")    # keep the ranges of this small table apart
    try:
        at = first_lines(line_hashes(table(spark, rows))).withColumn("part", F.spark_partition_id())
        return at.groupBy("h1", "h2").agg(F.countDistinct("part").alias("n")).agg(F.max("n")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_plan_is_native_with_one_shuffle_of_lines(spark):
    from riskloom.llm.line_dedup import first_lines, line_hashes
    plan = first_lines(line_hashes(table(spark, ODD)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.lists(st.sampled_from(["a", " A", "b", "", "É", "é", "c\t"]), max_size=6).map("\n".join)), max_size=12))
def test_any_rows(spark, rows):
    assert run(spark, rows, min_docs=2) == brute(rows, min_docs=2)


def test_query(spark, tmp_path):
    rows = [(i, "Subscribe now\nBody %d" % i if i % 2 else None) for i in range(30)]
    table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in queries.op11_line_dedup(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(((i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in brute(rows)), key=str)

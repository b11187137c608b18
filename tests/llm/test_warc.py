import hashlib

import pytest
from pyspark.sql import functions as F

from riskloom.llm import warc as W
from riskloom.llm.common import scratch_path
from riskloom.llm.queries import op1_warc

BIG = "<p>" + "é" * 600 + "WARC/1.1\r\nWARC-Type: response\r\n\r\n</p>"


def page_rows():
    rows = [(i, f"http://a.example/{i}", BIG) for i in range(1, 40)]                      # a hot payload
    rows += [(50, "http://a.example/50\r\nX: y", None), (51, None, ""), (52, "http://a.example/52", "small"), (53, "http://a.example/53", "small")]
    rows += [(60, "u", "x" * 999), (61, "u", "x" * 999), (62, "u", "y" * 1000), (63, "u", "y" * 1000), (63, "u", "y" * 1000), (None, "n", "z" * 2000), (70, "\r\n\r\n", "\r\n\r\nWARC/1.1\r\n")]
    return rows


def expected(rows):
    """A result per row: of equal payloads of 1000 bytes or more, one row of the largest id is the response."""
    out, groups = [], {}
    for r in rows:
        groups.setdefault((r[2] or "").encode(), []).append(r[0])
    for body, ids in groups.items():
        ids.sort(key=lambda i: (i is None, -(i or 0)))
        for place, i in enumerate(ids):
            again = len(body) >= 1000 and place > 0
            out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", ids[0] if again else None))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, tmp_path):
    rows = page_rows() + [(80, "same", "w" * 3000)] * 30 + [(81, "same", "small")] * 4 + [(None, None, None)] * 3
    rows += [(90, "one", "v" * 1500), (90, "two", "v" * 1500), (89, "one", "v" * 1500)]         # one id, two urls
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("id", F.lit("clash"))
    df.write.parquet(str(tmp_path / "pages.parquet"))
    got = op1_warc(spark, str(tmp_path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip_of_payloads(spark, compression):
    rows = page_rows()
    path = scratch_path(spark, "t")
    W.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), path, compression=compression, records_per_file=7)
    recs = W.read_warc(spark, path).collect()
    assert len(recs) == 3 * (len(rows))
    responses = [r for r in recs if r["type"] == "response"]
    assert {bytes(r["payload"]).decode() for r in responses} == {(h or "") for _, _, h in rows}
    assert all(r["http_status"] == 200 and r["payload_bytes"] == len(r["payload"]) for r in responses)


def record(i, kind, to=()):
    return (i, kind, list(to), {})


def test_assembly_by_either_side_and_through_requests(spark):
    rows = [record("c1", "response"), record("q1", "request", ["c1"]), record("m1", "metadata", ["q1"]),
            record("c2", "response", ["q2"]), record("q2", "request"), record("lost", "metadata", ["none"]), record("c3", "revisit"), record("q1", "request", ["c1"])]
    rows += [record(f"h{i}", "metadata", ["c3"]) for i in range(25)]
    df = spark.createDataFrame(rows, "record_id string, type string, concurrent_to array<string>, fields map<string,string>")
    got = W.assemble_transactions(df, most_related=10).collect()
    ids = lambda x: [r["record_id"] for r in x]
    whole = {(r["record_id"], r["part"]): (ids(r["requests"]), ids(r["metadata"])) for r in got if r["record_id"]}
    assert whole[("c1", 0)] == (["q1"], ["m1"]) and whole[("c2", 0)] == (["q2"], [])
    hot = [v for k, v in whole.items() if k[0] == "c3"]
    assert len(hot) > 1 and sorted(i for _, m in hot for i in m) == sorted(f"h{i}" for i in range(25))
    assert [ids(r["metadata"]) for r in got if r["record_id"] is None] == [["lost"]]


def test_damage_and_empty(spark, tmp_path):
    good = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http\r\nWARC-Payload-Digest: sha1:00\r\nContent-Length: 19\r\n\r\nHTTP/1.1 200 OK\r\n\r\n\r\n\r\n"
    with pytest.raises(ValueError, match="digest"):
        list(W.parse_records(good))
    with pytest.raises(ValueError, match="length"):
        list(W.parse_records(good.replace(b": 19", b": 18")))
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert op1_warc(spark, str(tmp_path)).count() == 0

import duckdb

from riskloom.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


def test_queries_match_their_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in ORACLE_SQL.items():
        df, rel = QUERIES[name](spark, SF), con.sql(sql)
        assert sorted(df.columns) == sorted(rel.columns)
        at = [rel.columns.index(c) for c in df.columns]
        want = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=str)
        assert sorted((tuple(r) for r in df.collect()), key=str) == want

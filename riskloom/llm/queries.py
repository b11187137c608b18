"""The registered queries of this subpackage: ``opN_<name>`` and ``pipeline``, with their SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from .common import held_out, scratch_path, table, write_table
from .conversation import damaged, decide_repairs, repair_digests
from .html_main import main_text
from .line_dedup import apply_bitmaps, line_bitmaps
from .merkle import build_manifest, lowered_where, verify_rows
from .multi_index import nearest
from .packing import pack_best_fit
from .projection_dedup import near_duplicate_vectors
from .quality import fit_quality, quality_scores
from .simhash import fingerprint_hex, simhash_groups
from .token_files import crc_of, read_token_files, write_token_files
from .toxicity import fit_toxicity, toxicity_scores
from .viterbi import decode_pieces, encode_pieces
from .warc import assemble_transactions, read_warc, write_warc

QUALITY_THRESHOLD = corpus_pipeline.QUALITY_THRESHOLD
TOXICITY_THRESHOLD = corpus_pipeline.TOXICITY_THRESHOLD
END_ID = 2


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    records = read_warc(spark, path, payload=False).drop("payload")
    captures = assemble_transactions(records).where(F.col("record_id").isNotNull() & (F.col("part") == 0)).select(
        "record_id", F.col("metadata")[0]["fields"]["pageId"].cast("long").alias("page_id"), F.col("capture.type").alias("record_type"),
        F.col("capture.refers_to").alias("refers"), F.col("capture.payload_bytes").alias("bytes"), F.col("capture.payload_digest").alias("payload_digest"))
    captures = write_table(captures, "warc-captures")
    firsts = captures.where(F.col("record_type") == "response").select(F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to"), F.col("bytes").alias("first_bytes"))
    # revisits of one page may be many: they are the left side, which AQE splits
    return captures.join(firsts, "refers", "left").select("page_id", F.coalesce("bytes", "first_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH d AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages
), f AS (
  SELECT *, row_number() OVER (PARTITION BY digest ORDER BY page_id DESC NULLS LAST) AS place, max(page_id) OVER (PARTITION BY digest) AS first_id FROM d
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND place > 1 THEN first_id END AS refers_to
FROM f
"""


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def op2_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_best_fit(table(spark, sf_dir, "documents").select("doc_id", word_count(F.col("text")).alias("length")))


def _scored(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _scored(quality_scores(docs, fit_quality(docs, table(spark, sf_dir, "labels"))), QUALITY_THRESHOLD)


def op4_projection_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"), END_ID)
    docs = write_table(read_token_files(spark, path, crc_of, "long"), "token-documents")
    # ids before each file: one row per file
    files = docs.groupBy("file", F.regexp_extract("file", r"part-(\d+)", 1).cast("long").alias("part")).agg(F.sum("n_tokens").alias("n"))
    rows = files.orderBy("part").collect()
    offsets, total = [], 0
    for r in rows:
        offsets.append((r["file"], total))
        total += r["n"]
    shift = spark.createDataFrame(offsets, "file string, shift long")
    return docs.join(F.broadcast(shift), "file").select("doc_id", (F.col("shift") + F.col("start")).alias("start"), "n_tokens", F.col("state").alias("ids_crc32"))


def op6_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op7_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_groups(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return out.select("doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _scored(toxicity_scores(docs, fit_toxicity(docs, table(spark, sf_dir, "labels"))), TOXICITY_THRESHOLD)


def _pieces(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    model = tokenizer_file("piece_bpe_32k.model")
    out = decode_pieces(encode_pieces(table(spark, sf_dir, "documents"), model, method=method), model)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"),
                      F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"))


def op10_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir, "viterbi")


def op10b_piece_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir, "merge")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = apply_bitmaps(docs, line_bitmaps(docs, min_docs=10, min_chars=1))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines,
         sha256(coalesce(text, '')) AS h FROM documents
), l AS (
  SELECT n, doc_id, h, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), hot AS (
  SELECT key FROM (SELECT DISTINCT key, doc_id, h FROM k WHERE key <> '') GROUP BY key HAVING count(*) >= 10
), m AS (
  SELECT k.*, hot.key IS NOT NULL AS gone FROM k LEFT JOIN hot USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY n
"""


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.coalesce(held_out(F.col("doc_id")), F.lit(False))      # crc32(decimal doc_id) divisible by 5
    return verify_rows(spark, build_manifest(table(spark, sf_dir, "documents"), lowered_where(tampered)))


def _crc32_sql(text: str) -> str:
    """CRC-32 (unsigned) of an ASCII text."""
    return f"""xor(list_reduce(list_transform(range(1, strlen({text}) + 1), lambda i: CAST(ord(substr({text}, i, 1)) AS BIGINT)),
        lambda c, b: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
        4294967295), 4294967295)"""


def _merkle_sql(levels: int = 6) -> str:
    """The trees level by level, each from the one below: whole for up to 16 ** levels rows in a source, and as many sources."""
    def field(c: str) -> str:
        return f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c}, '-')"

    def tree(t: str) -> list[str]:
        """{t}0(g, p, d) to nodes of each level, and the runs' digests joined."""
        out = []
        for k in range(levels):
            out.append(f"{t}r{k} AS (SELECT g, p // 16 AS p, string_agg(d, '' ORDER BY p) AS run, max(c) AS c FROM {t}{k} GROUP BY ALL)")
            out.append(f"{t}{k + 1} AS (SELECT g, p, CASE WHEN c > 1 THEN sha256(run) ELSE run END AS d, count(*) OVER (PARTITION BY g) AS c FROM {t}r{k})")
        return out

    def walk(t: str, start: str) -> list[str]:
        """{t}w0 = start(id, g, p, proof, f) up to the root: siblings appended, f folded."""
        out = [f"{t}w0 AS ({start})"]
        for k in range(levels):
            left, right = "left(r.run, CAST(64 * (w.p % 16) AS BIGINT))", "substr(r.run, CAST(64 * (w.p % 16) + 65 AS BIGINT))"
            out.append(f"""{t}w{k + 1} AS (SELECT w.id, w.g, w.p // 16 AS p, CASE WHEN r.c > 1 THEN w.proof || {left} || {right} ELSE w.proof END AS proof,
                CASE WHEN r.c > 1 THEN sha256({left} || w.f || {right}) ELSE w.f END AS f FROM {t}w{k} w JOIN {t}r{k} r ON r.g = w.g AND r.p = w.p // 16)""")
        return out

    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = _crc32_sql("CAST(doc_id AS VARCHAR)")
    parts = [
        f"t AS (SELECT *, sha256({head} || {field('text')}) AS leaf, row_number() OVER () AS id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM documents)",
        f"u AS (SELECT *, CASE WHEN coalesce({crc} % 5 = 0, false) THEN sha256({head} || {field(lowered)}) ELSE leaf END AS changed FROM t)",
        "v AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, id) - 1 AS p FROM u)",
        "s0 AS (SELECT g, p, leaf AS d, count(*) OVER (PARTITION BY g) AS c FROM v)", *tree("s"),
        f"h0 AS (SELECT 0 AS g, g AS p, d, count(*) OVER () AS c FROM s{levels})", *tree("h"),
        *walk("s", "SELECT id, g, p, '' AS proof, changed AS f FROM v"),
        *walk("h", f"SELECT id, 0 AS g, g AS p, proof, f FROM sw{levels}"),
    ]
    return "WITH " + ",\n".join(parts) + f"""
SELECT v.doc_id, v.leaf, s.d AS subroot, h.d AS root, sha256(w.proof) AS proof_sha256, w.f AS folded_root, w.f = h.d AS verified
FROM v JOIN hw{levels} w USING (id) JOIN s{levels} s ON s.g = v.g JOIN h{levels} h ON true"""


OP12_SQL = _merkle_sql()


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    return repair_digests(rows, decide_repairs(rows, "absent"), "absent")


# row by row, the best (cost, audit) for each last role: state 0 nothing, 1 system, 2 user, 3 assistant
OP13_SQL = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS t,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), h AS (
  SELECT *, """ + _crc32_sql("k") + r""" % 20 AS hit FROM c
), damage AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE r END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(t, '[.!?]', '', 'g') ELSE t END AS text
  FROM h, (VALUES (0), (1)) v(again) WHERE hit <> 0 AND (again = 0 OR hit = 3)
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damage
), rows AS (
  SELECT *, left(role, 1) AS ini, CASE WHEN bare = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         row_number() OVER w AS i, lag(left(role, 1)) OVER w AS before
  FROM seen WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), nth)
), convs AS (
  SELECT g.conv_id, g.g, count(rows.i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT conv_id, row_number() OVER () AS g FROM (SELECT DISTINCT conv_id FROM conversations)) g
  LEFT JOIN rows ON rows.conv_id IS NOT DISTINCT FROM g.conv_id GROUP BY ALL
), ins(st, mid, ia, ic, it) AS (
  VALUES (0, 0, '', 0, ''), (0, 2, 'I', 3, 'user:' || chr(10)), (0, 3, 'II', 6, 'user:' || chr(10) || 'assistant:' || chr(10)),
         (1, 1, '', 0, ''), (1, 2, 'I', 3, 'user:' || chr(10)), (1, 3, 'II', 6, 'user:' || chr(10) || 'assistant:' || chr(10)),
         (2, 2, '', 0, ''), (2, 3, 'I', 3, 'assistant:' || chr(10)), (2, 2, 'II', 6, 'assistant:' || chr(10) || 'user:' || chr(10)),
         (3, 3, '', 0, ''), (3, 2, 'I', 3, 'user:' || chr(10)), (3, 3, 'II', 6, 'user:' || chr(10) || 'assistant:' || chr(10))
), x AS (
  SELECT g.g, i, ini, role, text, fault IN ('blank', 'duplicate') AS must, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS cut
  FROM rows JOIN convs g ON rows.conv_id IS NOT DISTINCT FROM g.conv_id
), moves AS (
  SELECT g, i, 'D' AS a, 4 AS c, s AS mid, s AS st, '' AS t FROM x, range(4) v(s)
  UNION ALL SELECT g, i, 'K', cut, mid, st, role || ':' || text || chr(10) FROM x, (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)) k(ini, mid, st)
    WHERE NOT must AND x.ini = k.ini
  UNION ALL SELECT g, i, 'R', 3 + cut, mid, st, (CASE st WHEN 2 THEN 'user:' ELSE 'assistant:' END) || text || chr(10) FROM x, (VALUES (0, 2), (1, 2), (3, 2), (2, 3)) k(mid, st)
    WHERE NOT must
), search AS (
  SELECT g, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS st, CAST(0 AS BIGINT) AS cost, '' AS audit, '' AS out FROM convs
  UNION ALL
  SELECT g, i, st, cost, audit, out FROM (
    SELECT m.g, m.i, CAST(m.st AS BIGINT) AS st, s.cost + ic + m.c AS cost, s.audit || ia || m.a AS audit, s.out || it || m.t AS out,
           row_number() OVER (PARTITION BY m.g, m.st ORDER BY s.cost + ic + m.c, s.audit || ia || m.a) AS best
    FROM search s JOIN ins ON ins.st = s.st JOIN moves m ON m.g = s.g AND m.i = s.i + 1 AND m.mid = ins.mid
  ) WHERE best = 1
), done AS (
  SELECT s.g, s.cost + ic AS cost, s.audit || ia AS audit, s.out || it AS out,
         row_number() OVER (PARTITION BY s.g ORDER BY s.cost + ic, s.audit || ia) AS best
  FROM search s JOIN convs USING (g) JOIN ins ON ins.st = s.st WHERE s.i = convs.n AND ins.mid IN (0, 3)
)
SELECT conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal, CAST(cost AS BIGINT) AS cost, audit,
       sha256(left(out, greatest(length(out) - 1, 0))) AS repaired_sha256
FROM done JOIN convs USING (g) WHERE best = 1
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_warc": op1_warc,
    "op2_best_fit": op2_best_fit,
    "op3_quality": op3_quality,
    "op4_projection_dedup": op4_projection_dedup,
    "op5_token_files": op5_token_files,
    "op6_multi_index": op6_multi_index,
    "op7_host_suffix_array": op7_host_suffix_array,
    "op8_simhash": op8_simhash,
    "op9_toxicity": op9_toxicity,
    "op10_piece_viterbi": op10_piece_viterbi,
    "op10b_piece_merge": op10b_piece_merge,
    "op11_line_dedup": op11_line_dedup,
    "op12_merkle": op12_merkle,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {"op1_warc": OP1_SQL, "op11_line_dedup": OP11_SQL, "op12_merkle": OP12_SQL, "op13_conversation_repair": OP13_SQL}

import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.llm import token_files as T
from riskloom.llm import viterbi as V
from riskloom.llm import wordtable as W
from riskloom.llm.common import scratch_path
from riskloom.llm.queries import op5_token_files, tokenizer_file

WORDS, PIECES = tokenizer_file("word_bpe_49k.json"), tokenizer_file("piece_bpe_32k.model")
TEXTS = ["Hello  world\nfoo", "", " ", "  a ", "日本語 é ü\t\x00x", "▁x y", "a▁ b", "a▁b", "a" * 300, "🙂 ok 🙂🙂", "a  ", " a", "x  y  z", "don't he'll 3rd ²½ª İI ΣΑΣ x\x1cy",
         "a<|endoftext|>b <|EndOfText|>", "The the THE the. the, the!! é É", None, "\n\n a\n", " ".join(f"wörd{i}" for i in range(3000))]


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**32 - 1), st.integers(49000, 49407)), max_size=2500))
@settings(max_examples=60, deadline=None)
def test_blocks_round_trip(values):
    ids = np.array(values, np.uint32)
    blocks = T.pack_blocks(ids)
    starts = np.concatenate(([0], np.cumsum([len(b) for b in blocks])[:-1])).astype(np.int64) if blocks else np.empty(0, np.int64)
    assert (T.unpack_blocks(b"".join(blocks), starts, len(ids)) == ids).all()
    if len(blocks) > 1:  # from a block's start in the index
        data = b"".join(blocks)
        assert (T.unpack_blocks(data[starts[1]:], starts[1:] - starts[1], len(ids) - T.BLOCK) == ids[T.BLOCK:]).all()


def test_outliers_are_exceptions():
    ids = np.arange(1024, dtype=np.uint32) % 16
    ids[[5, 700]] = 49407
    assert len(T.pack_blocks(ids)[0]) == T.BLOCK_HEAD.size + 4 * 32 * 4 + 2 * 6


def test_texts_encode_as_the_library_does():
    enc = T.TextEncoder(WORDS)
    for _ in range(2):  # new and seen words
        for t, (_, ids) in zip(TEXTS, enc(pa.array(TEXTS))):
            assert ids.tolist() == enc.tokenizer.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("seg_ids", [1 << 18, 50])
def test_files_round_trip(spark, seg_ids):
    rows = [(i * 3 % 47, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (3, "b"), (3, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("clash")).withColumn("segment", F.lit(1))
    path = scratch_path(spark, "t")
    T.write_token_files(df, path, WORDS, seg_ids=seg_ids)
    tok = T.TextEncoder(WORDS).tokenizer
    want = [(d, tok.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))]
    got = sorted(T.read_token_files(spark, path).collect(), key=lambda r: (r["file"].split("part-")[1][:5], r["at"]))
    assert [(r["doc_id"], r["ids"]) for r in got] == want
    states = {(r["file"], r["at"]): r["state"] for r in T.read_token_files(spark, path, T.crc_of, "long").collect()}
    assert all(states[(r["file"], r["at"])] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got)


def test_query_starts(spark, tmp_path):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    tok, at = T.TextEncoder(WORDS).tokenizer, 0
    got = {r["doc_id"]: r for r in op5_token_files(spark, str(tmp_path)).collect()}
    for d, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        assert (got[d]["start"], got[d]["n_tokens"], got[d]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def brute_viterbi(word, scores, unknown, longest):
    best = [(0.0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - longest), end):
            piece = word[start:end]
            score = scores.get(piece, unknown if len(piece) == 1 else None)
            if score is not None and (best[end] is None or best[start][0] + score > best[end][0]):
                best[end] = (best[start][0] + score, start)
    out, end = [], len(word)
    while end:
        out.insert(0, word[best[end][1]: end])
        end = best[end][1]
    return out


def test_viterbi_equals_brute_force():
    p = V.Pieces(PIECES)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    scores = {sp.id_to_piece(int(i)): s for i, s in zip(p.ids, p.scores)}
    words = {w for t in TEXTS if t for w in p.units("▁" + t)}
    by_size = {}
    for w in words:
        if not p.strange.search(w):
            by_size.setdefault(len(w), []).append(w)
    for group in by_size.values():
        for w, ids in zip(group, p.viterbi(group)):
            want = [i for x in brute_viterbi(w, scores, p.unknown_score, p.longest) for i in ([sp.piece_to_id(x)] if x in scores else p.spell(x).tolist())]
            assert ids.tolist() == want


def test_merges_equal_the_library():
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    enc = V.Encoder(PIECES, "merge")
    for _ in range(2):
        for t, (_, ids) in zip(TEXTS, enc(pa.array(TEXTS))):
            assert ids.tolist() == sp.encode(t or "")


@pytest.mark.parametrize("method", ["viterbi", "merge"])
def test_decoding(spark, method):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x"), (3, TEXTS[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("id", F.lit(2))
    got = V.decode_pieces(V.encode_pieces(df, PIECES, method=method), PIECES).collect()
    assert len(got) == len(rows)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in got:
        assert r["decoded"] == (r["text"] or "").replace("▁", " ") == sp.decode(r["ids"]) if r["ids"] else r["decoded"] == ""
    assert V.encode_pieces(df.limit(0), PIECES).count() == 0


def _long_words():
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghiklmnoprstuvwyz01é"))
    return ["▁" + "".join(rng.choice(letters, n)) for n in (1, 2, 3, 40, 3000)] + ["▁" + "the" * 700 + "a" * 900, "aaaaaaaaaaaaaaaa" * 200]


def test_long_words_equal_the_batches(monkeypatch):
    p = V.Pieces(PIECES)
    monkeypatch.setattr(V, "WINDOW", 64)
    for w in _long_words():
        assert p.viterbi_long([w])[0].tolist() == p.viterbi([w])[0].tolist()
        assert p.merge_long([w])[0].tolist() == p.merge([w])[0].tolist()


@pytest.mark.parametrize("method", ["viterbi", "merge"])
def test_word_of_a_megabyte(method):
    """Time about linear in the word's length: 100,000 characters took 22 s in the batch."""
    import time
    rng = np.random.default_rng(9)
    word = "".join(rng.choice(np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/")), 1_000_000))
    enc, t = V.Encoder(PIECES, method), time.perf_counter()
    (_, ids), = enc(pa.array([word]))
    assert time.perf_counter() - t < 60     # measured: README
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert sp.decode(ids.tolist()) == word
    print(method, round(time.perf_counter() - t, 1))


def _spans(words):
    data = np.frombuffer("".join(words).encode(), np.uint8)
    sizes = np.array([len(w.encode()) for w in words])
    return data, np.cumsum(sizes) - sizes, sizes, V.SAME


def test_word_table_forgets_words_met_once():
    """Bounded whatever the vocabulary; frequent words are encoded once (all were forgotten together before)."""
    seen = []
    table = W.WordTable(lambda words: seen.extend(words) or [np.arange(len(w), dtype=np.int32) for w in words], most=100)
    often = [f" common{k}" for k in range(10)]
    for i in range(40):
        words = [w for k in range(50) for w in (f" new{i}-{k}", often[k % 10])]
        ids, ends = table(*_spans(words))
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [list(range(len(w))) for w in words]
        assert len(table) <= 100 + 60 and len(table.ids) <= 160 * 10
    assert sorted(w for w in seen if "common" in w) == often


def test_word_table_of_a_worker_is_bounded():
    """All words new, with the bound that the encoders use: a million words were held before."""
    enc = V.Encoder(PIECES, "merge")
    table = W.WordTable(lambda words: [np.zeros(1, np.int32)] * len(words), enc.table.most)
    for at in range(0, 1_000_000, 50_000):
        table(*_spans([f" {k}" for k in range(at, at + 50_000)]))
    assert len(table) <= 650_000


def test_span_hashes_by_blocks(monkeypatch):
    words = [f" w{k}" for k in range(300)] + [" " + "x" * 5000, " y"] + [" z" * k for k in range(1, 60)] + [" " + "q" * 2000]
    whole = W.span_hashes(*_spans(words)).tolist()
    assert len(set(whole)) == len(words)
    for block in (W.LONG, 100, 1000, 1 << 20):
        monkeypatch.setattr(W, "BLOCK", block)
        assert W.span_hashes(*_spans(words)).tolist() == whole


def test_decoder_shares_the_pieces():
    """One copy of the model a worker, whatever the method that encoded."""
    assert V.encoder(PIECES, "merge").pieces is V.encoder(PIECES, "viterbi").pieces

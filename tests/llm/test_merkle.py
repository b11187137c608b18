import hashlib
import zlib

import numpy as np
import pytest

from riskloom.llm import queries
from riskloom.llm.merkle import ARITY, BLOCK, Path, addresses, build_block, build_manifest, leaf_paths, tree_levels, unpack, verify_rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, gid string, pos int, digest string, blk int"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def up(nodes):
    """Levels of a tree, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i: i + ARITY])) for i in range(0, len(levels[-1]), ARITY)])
    return levels


def walk(levels, i, own):
    """Siblings and folded root from node i of the lowest level."""
    siblings = ""
    for level in levels[:-1]:
        at = i // ARITY * ARITY
        left, right = "".join(level[at:i]), "".join(level[i + 1: at + ARITY])
        siblings, own, i = siblings + left + right, sha(left + own + right), i // ARITY
    return siblings, own


def brute(rows):
    groups = {}
    for r in rows:
        t = r[1]
        if t is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
            t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        groups.setdefault(r[3], []).append((r[0], leaf(r, r[1]), leaf(r, t)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = up([x[1] for x in groups[s]])
    top = up([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (doc, own, changed) in enumerate(groups[s]):
            below, folded = walk(trees[s], i, changed)
            above, folded = walk(top, k, folded)
            out.append((doc, own, trees[s][-1][0], top[-1][0], sha(below + above), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "g", 1, "d", 2) for r in rows], SCHEMA)


def run(spark, rows, tmp_path):
    table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    return sorted((tuple(r) for r in queries.op12_merkle(spark, str(tmp_path)).collect()), key=str)


@pytest.mark.parametrize("height", [1, 2, 3, 4, 5])
def test_addresses(height):
    place = addresses(height)
    every = np.concatenate(place)
    assert [len(p) for p in place] == [ARITY ** d for d in range(height)]
    assert np.array_equal(np.sort(every), np.arange(len(every)))
    if height == 4:     # halves of two levels: 17 nodes together, first the upper half
        for first, inside in [(place[0][0], place[1]), *((a, place[3][ARITY * i: ARITY * i + ARITY]) for i, a in enumerate(place[2]))]:
            assert np.array_equal(inside, first + 1 + np.arange(ARITY))


@pytest.mark.parametrize("m", [1, 2, 16, 17, 255, 300, 4096])
def test_block_and_paths(m):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(m)]
    levels = up([x.hex() for x in leaves])
    block = build_block(leaves, tree_levels(m))
    assert block[:32].hex() == levels[-1][0]
    paths = leaf_paths(block, tree_levels(m), m, Path((), b""))
    for i in {0, m // 2, m - 1}:
        assert unpack(paths[i].pack()) == paths[i]
        assert paths[i].joined.decode() == walk(levels, i, "")[0]
        assert paths[i].fold(leaves[i]).decode() == levels[-1][0]


def test_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (None, "Text", "en", "a", 4), (1, "A", "en", "a", 1), (1, "A", "en", "a", 1),
            (1, "B", "en", "a", 1), (2, "", "de", "", 0), (3, "É Z", None, "é", 3), (4, "Z" * 300_000, "en", "Z", 300_000), (5, "x", "en", "z", None)]
    rows += [(i, f"Row {i}", "en", f"s{i % 40}", 5) for i in range(10, 120)]
    got = run(spark, rows, tmp_path)
    assert got == brute(rows)
    assert {r[6] for r in got} == {True, False}


def test_sources_beyond_a_block(spark, tmp_path):
    rows = [(i, f"T{i}", "en", "hot", 2) for i in range(BLOCK + 17)] + [(i, "t", "en", "cold", 1) for i in range(20_000, 20_003)] + [(7, "same", "en", "copies", 4)] * 300
    assert run(spark, rows, tmp_path) == brute(rows)


def test_many_sources(spark, tmp_path):
    rows = [(i, "t", "en", f"host{i}", 1) for i in range(BLOCK + 3)]
    assert run(spark, rows, tmp_path) == brute(rows)


def test_single_row_and_empty_table(spark, tmp_path):
    one = [(9, "T", "en", "s", 1)]
    assert run(spark, one, tmp_path) == brute(one)
    manifest = build_manifest(table(spark, []))
    assert verify_rows(spark, manifest).collect() == [] and manifest.trees == [] and manifest.subroots.count() == 0

"""The Merkle manifest against a plain tree in Python, and the stored layout against its definition."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from secflow.llm import merkle


def h(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x) -> str:
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf_of(row) -> str:
    return h(map(field, row))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def path_of(levels, i):
    runs = []
    for level in levels[:-1]:
        start = i // 16 * 16
        runs.append((i - start, level[start:start + 16]))
        i //= 16
    return runs


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> sorted result rows."""
    trees = {}
    for source in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == source), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[source] = own, levels_of([leaf_of(r) for r in own])
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    top = levels_of([trees[s][1][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        own, levels = trees[s]
        for i, r in enumerate(own):
            runs = path_of(levels, i) + path_of(top, k)
            proof = h(x for at, run in runs for j, x in enumerate(run) if j != at)
            now = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                now = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            node = leaf_of(now)
            for at, run in runs:
                node = h([*run[:at], node, *run[at + 1:]])
            out.append((r[0], leaf_of(r), levels[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, key string, block long"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in merkle.manifest(df).collect()), key=repr)


def test_manifest_equals_plain_trees(spark):
    rng = random.Random(1)
    rows = []
    for i in range(700):
        source = rng.choice(["hot"] * 5 + ["a", "é", "Z", None, "z1", "z2"])
        rows.append((rng.choice([i] * 20 + [None]), source, rng.choice(["en", None]), rng.choice([i, None]),
                     rng.choice(["Abc é", "lower", "", None, "X" * 3000])))
    rows += [(5000 + i, f"s{i}", "en", 1, "One") for i in range(40)] + rows[:30]
    got = run(spark, rows)
    assert got == brute(rows)
    assert 0 < sum(not r[-1] for r in got) < 200


def test_blocks_and_tiers_of_several_levels(spark, monkeypatch):
    rows = [(i, "hot" if i % 3 else f"s{i % 300}", "en", i, f"Text {i}") for i in range(1500)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    leaves, _ = merkle.positions(merkle.manifest_rows(df), ["doc_id", "leaf"])
    assert sorted(r.pos for r in leaves.filter("key = 'shot'").collect()) == list(range(1000))
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("n", [4095, 4096, 4097, 9000])
def test_sources_around_a_whole_block(spark, n):
    rows = [(i, "hot", None, None, None) for i in range(n)]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_single_row(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, None, None, None, None)]) == brute([(None, None, None, None, None)])


@pytest.mark.parametrize("bottom,height", [(1, 1), (16, 2), (17, 3), (256, 3), (300, 4), (4096, 4), (4000, 4), (1, 4)])
def test_layout_is_a_permutation_with_whole_subtrees_together(bottom, height):
    counts = [bottom]
    for _ in range(height - 1):
        counts.append(-(-counts[-1] // 16))
    places = [merkle.address(bottom, height, depth) for depth in range(height)]
    assert [len(p) for p in places] == counts[::-1]
    assert sorted(np.concatenate(places).tolist()) == list(range(merkle.size(bottom, height)))
    top = height // 2
    if top:
        # The top half of the levels comes first, and every bottom subtree is one contiguous stretch.
        above = sum(len(places[d]) for d in range(top))
        assert max(int(places[d].max()) for d in range(top)) == above - 1
        for k, start in enumerate(places[top].tolist()):
            inside = [places[d][k * 16 ** (d - top):(k + 1) * 16 ** (d - top)] for d in range(top, height)]
            flat = sorted(np.concatenate(inside).tolist())
            assert flat == list(range(start, start + len(flat)))

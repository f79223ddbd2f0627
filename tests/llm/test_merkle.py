"""Manifest, proofs and log against plain recursion over lists."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from hopgrid.llm import merkle, queries


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text=None):
    doc_id, source, lang, n_chars, plain = row
    values = [doc_id, source, lang, n_chars, plain if text is None else text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(leaves):
    """Root and for each leaf its runs, level by level (the run, own place)."""
    level, where, steps = leaves, list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        runs = [level[i:i + 3] for i in range(0, len(level), 3)]
        for leaf, at in enumerate(where):
            steps[leaf].append((runs[at // 3], at % 3))
            where[leaf] = at // 3
        level = [h(*r) for r in runs]
    return level[0], steps


def plain(rows):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        by_source[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {name: tree([leaf_of(r) for r in by_source[name]]) for name in names}
    root, over = tree([trees[n][0] for n in names])
    out = []
    for place, name in enumerate(names):
        for row, steps in zip(by_source[name], trees[name][1]):
            even = zlib.crc32(str("" if row[0] is None else row[0]).encode()) % 2 == 0
            digest = leaf_of(row, row[4].replace("\n", "") if even and row[4] is not None else None)
            others = []
            for run, at in steps + over[place]:
                others += [d for i, d in enumerate(run) if i != at]
                digest = h(*run[:at], digest, *run[at + 1:])
            out.append((row[0], leaf_of(row), trees[name][0], root, h(*others), digest, digest == root))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "doc_id long, source string, lang string, n_chars long, text string, place string, tree int")


def documents(sizes, seed=1):
    rng, rows = random.Random(seed), []
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((rng.choice([None, *range(9000)]), source, rng.choice([None, "en"]), rng.choice([None, 3]),
                         rng.choice([None, "", "a\nb", "long " * 2000 + "\n", "é\n漢", "plain"])))
    return rows + rows[:5] + rows[:5]  # repeated rows


@pytest.mark.parametrize("sizes, levels", [
    ({None: 2, "": 1, "é": 5, "z": 9, "Z": 28}, 6), ({f"s{i}": 1 + i % 4 for i in range(90)} | {"hot": 400}, 2), ({"one": 730}, 6)])
def test_query_against_plain_trees(spark, tmp_path, monkeypatch, sizes, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows = documents(sizes)
    frame(spark, rows).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_merkle_manifest(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


def test_log_positions(spark, monkeypatch):
    """The log of a source is the postorder of its whole tree, without a gap."""
    monkeypatch.setattr(merkle, "LEVELS", 2)
    manifest = merkle.build_manifest(frame(spark, documents({"a": 100, "b": 3, "c": 9, "d": 1, "e": 244})))
    logs = defaultdict(dict)
    for r in merkle.append_log(manifest).collect():
        assert r.position not in logs[r.tree]
        logs[r.tree][r.position] = (r.level, r["index"], bytes(r.digest).hex())
    leaves = defaultdict(dict)
    for r in manifest.leaves.collect():
        leaves[r.tree][r.place] = bytes(r.digest).hex()
    assert len(logs) == 5
    for number, log in logs.items():
        assert sorted(log) == list(range(len(log)))
        done: dict[int, list] = defaultdict(list)
        for at in range(len(log)):
            level, index, digest = log[at]
            assert index == len(done[level])
            if level:
                children = done[level - 1][3 * index:3 * index + 3]
                assert children and digest == h(*children)
            else:
                assert digest == leaves[number][index]
            done[level].append(digest)
        assert len(done[max(done)]) == 1


def test_address_is_postorder():
    for n in range(1, 200):
        log = merkle.write_log([b"%d" % i for i in range(n)], merkle.height_of(n))
        level, names = [b"%d" % i for i in range(n)], {}
        for depth in range(merkle.height_of(n) + 1):
            names |= {(depth, i): d for i, d in enumerate(level)}
            level = [sha256(b"".join(level[i:i + 3])).hexdigest().encode() for i in range(0, len(level), 3)]
        assert len(names) == len(log)
        assert all(log[merkle.address(*at, n)] == digest for at, digest in names.items())


def test_empty_table(spark):
    manifest = merkle.build_manifest(frame(spark, []))
    assert manifest.root is None and merkle.proofs(manifest).count() == 0 and merkle.append_log(manifest).count() == 0

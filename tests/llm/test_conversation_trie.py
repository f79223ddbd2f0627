"""The trie against plain dictionaries over all prefixes."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from hypothesis import given, settings, strategies as st

from hopgrid.llm import conversation_trie as ct


def plain_nodes(sequences):
    """(conv_id, depth) -> row of every node, from whole sequences of (role, text) by conversation."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids[node]), leaves[node], saved[node],
                    sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()) for node, m in members.items()), key=repr)


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()[:16]
            own[conv].append((turn is not None, turn or 0, digest, (role or "", text or "")))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def conversations(seed, convs, words, longest, hot=None):
    rng, rows = random.Random(seed), []
    for c in convs:
        for turn in range(hot[1] if hot and c == hot[0] else rng.randint(1, longest)):
            rows.append((c, turn if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None][:1 + words % 3]),
                         rng.choice([None, "", "é漢"] + ["w" * k for k in range(words)])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("span, fan, rows", [
    (64, 64, conversations(1, [*range(60), *range(100, 260)], 1, 9) + [(None, 1, "user", "x"), (7, 0, "user", "x"), (7, 0, "user", "x")]),
    (2, 2, conversations(2, [*range(0, 30), *range(205, 330)], 1, 8)),                     # no base for 205 to 299
    (3, 2, conversations(3, range(100, 160), 2, 12, hot=(100, 90)) + [(9, 0, "user", "long " * 3000)]),
    (64, 64, [(c, t, "user", f"turn {t}") for c in [*range(100), 5000] for t in range(100 + c % 3)]),  # copies, longer than a segment
])
def test_trie_against_dictionaries(spark, monkeypatch, span, fan, rows):
    monkeypatch.setattr(ct, "STRETCH", 4)
    monkeypatch.setattr(ct, "CHUNK", 3)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, digest string")
    got = sorted(map(tuple, ct.prefix_trie(frame, span, fan).collect()), key=repr)
    assert got == plain_nodes(rebuilt(rows))


def test_empty_table(spark):
    frame = spark.createDataFrame([(None, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    assert ct.prefix_trie(frame).count() == 0


def by_forest(keys, cuts, fan):
    """Finished nodes of runs that are contracted and merged, in plain Python."""
    def shared(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    lcp = [-1] + [shared(a, b) for a, b in zip(keys, keys[1:])] + [-1]
    nodes = [ct.Node(len(k), ct.Part(10 * i + 5, 1, int(lcp[i + 1] != len(k)), 0, 0, i)) for i, k in enumerate(keys)]
    edges = [(lcp[i], sum(range(lcp[i] + 1)), repr((lcp[i], k[:max(lcp[i], 0)])).encode()) for i, k in enumerate(keys)]
    places = sorted({0, len(keys), *[c for c in cuts if c < len(keys)]})
    runs = [(nodes[a:b], edges[a:b], lcp[b]) for a, b in zip(places, places[1:])]
    done = []
    while runs:
        merged = []
        for part, edge, right in runs:
            finished, left = ct.contract(part, *map(list, zip(*edge)), right)
            done.extend(finished)
            merged.append(([n for n, *_ in left], [tuple(e) for _, *e in left], right))
        merged = [m for m in merged if m[0]]
        runs = [([n for m in merged[i:i + fan] for n in m[0]], [e for m in merged[i:i + fan] for e in m[1]], merged[min(i + fan, len(merged)) - 1][2])
                for i in range(0, len(merged), fan)]
    return done


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("ab", max_size=6), min_size=1, max_size=40), st.lists(st.integers(1, 39), max_size=12), st.integers(2, 4))
def test_contraction_over_any_boundaries(keys, cuts, fan):
    keys = sorted(keys)
    done = by_forest(keys, cuts, fan)
    want = defaultdict(list)
    for i, k in enumerate(keys):
        for d in range(len(k) + 1):
            want[k[:d]].append(i)
    branching = {p: m for p, m in want.items() if p in keys or len({k[len(p)] for k in keys if k.startswith(p) and len(k) > len(p)}) > 1}
    assert len(done) == len(branching)
    prefixes = {(10 * min(m) + 5, len(p)): (p, m) for p, m in branching.items()}
    for node in done:
        prefix, members = prefixes.pop((node.total.owner, node.depth))
        kids = {k[:len(prefix) + 1] for k in keys if k.startswith(prefix) and len(k) > len(prefix)}
        assert node.total.n == len(members)
        assert node.total.children == len(kids)
        assert node.total.leaves == sum(not any(o.startswith(k) and o != k for o in keys) for k in keys if k.startswith(prefix))
        assert (node.total.end is not None) == (prefix in keys)
        assert node.total.saved - (len(members) - 1) * sum(range(len(prefix))) == sum(
            (len(m) - 1) * len(p) for p, m in want.items() if p.startswith(prefix))
    assert not prefixes

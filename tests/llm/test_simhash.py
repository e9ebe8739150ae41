import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from trilode.llm import simhash
from trilode.llm.components import components


def plain_fingerprint(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles or [" ".join(words)]]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reachable(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_against_brute_force(docs):
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    fps = {d: plain_fingerprint(t) for d, t in texts.items()}
    ids = sorted(fps)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if (fps[a] ^ fps[b]).bit_count() <= 4]
    want = reachable(ids, pairs)
    assert {d: r.component_id for d, r in got.items()} == want
    assert {d: r.fp % 2**64 for d, r in got.items()} == fps


def test_links_of_many_dense_groups(spark):
    """A group of thousands within the radius, chains, and fingerprints that bits apart join."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 3000, np.uint64)
    near = base[:500] ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    dense = base[0] ^ sum(np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64) for _ in range(2))
    chain = [int(base[1])]
    for _ in range(12):
        chain.append(chain[-1] ^ sum(1 << int(b) for b in rng.choice(64, 4, replace=False)))
    fps = np.unique(np.concatenate([base, near, dense, np.array(chain, np.uint64)]))
    classes = spark.createDataFrame([(int(v),) for v in fps.view(np.int64)], "fp bigint")
    found = simhash.links(classes)
    assert found.count() < 4 * len(fps)
    got = {r.node: r.root for r in components(found).collect()}
    signed = fps.view(np.int64).tolist()
    pairs = [(signed[i], signed[i + 1 + j]) for i in range(len(fps))
             for j in np.nonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 4)[0]]
    want = reachable(signed, pairs)
    assert {n: got.get(n, n) for n in signed} == want


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32), st.integers(0, 5), st.integers(0, 2))
def test_tree_visits_every_point_within_the_radius(seed, depth, radius):
    rng = np.random.default_rng(seed)
    mask = (1 << 43) - (1 << 21)
    points = rng.integers(0, 2**63, 300, np.uint64)
    other = points.copy()
    for _ in range(radius):
        other ^= np.uint64(1) << rng.integers(21, 43, len(points)).astype(np.uint64)
    tree = simhash.fit_tree(points[:64], mask, radius, depth, seed)
    home = tree.home(other)
    row, leaf = tree.visits(points)
    assert set(zip(range(len(points)), home)) <= set(zip(row.tolist(), leaf.tolist()))


def test_odd_rows(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    blank = [r for r in rows if r.fp == 0]
    assert sorted(r.doc_id for r in blank if r.doc_id is not None) == [1, 2, 3]
    assert {r.component_id for r in blank} == {1}  # the row without id is in that group
    by_id = {(r.doc_id, r.text_hash): r for r in rows}
    assert {r.component_id for r in rows if r.doc_id in (4, 5)} == {4}
    assert {r.component_id for r in rows if r.doc_id in (6, 7)} == {6}
    assert len({r.component_text_hash for r in rows if r.doc_id == 9}) == 2 and by_id
    alone = [r for r in rows if r.doc_id is None and r.fp]
    assert [r.component_id for r in alone] == [None]
    assert simhash.near_duplicates(none).count() == 0


def test_keep_one(odd, none):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == {None: 1, 1: 1, 4: 1, 6: 1, 8: 1, 9: 2, 10: 1}
    assert simhash.keep_one(none).count() == 0


def test_keep_one_shuffles_whole_rows_once(spark):
    rows = [(None, "a b c d", "x"), (None, "a b c d", "x"), (1, "a b c d", "y"),
            (2, "quite another text here", "z"), (2, "quite another text here", "z"), (3, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = simhash.keep_one(docs)
        plan = kept._jdf.queryExecution().executedPlan()
        assert {tuple(r) for r in kept.collect()} == {rows[2], rows[3], rows[5]}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    whole, todo = 0, [plan]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.initialPlan())
            continue
        wide = any(node.output().apply(i).name() in ("text", "first")
                   for i in range(node.output().size()))
        whole += kind == "ShuffleExchangeExec" and wide
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert whole == 1



@pytest.mark.parametrize("edges,want", [
    ([], {}),
    ([(1, 1), (None, 2)], {}),
    ([(3, 1), (1, 3), (3, 2)], {1: 1, 2: 1, 3: 1}),
    ([(i, i + 1) for i in range(40)] + [(100, 101)], {**{i: 0 for i in range(41)}, 100: 100, 101: 100}),
    ([(9, i) for i in range(9)] + [(9, 9 + i) for i in range(1, 30)], {i: 0 for i in range(39)}),
])
def test_components(spark, edges, want):
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    assert {r.node: r.root for r in components(df).collect()} == want


def test_hex(spark):
    row = spark.createDataFrame([(-1,), (10,)], "fp bigint").select(simhash.hex_digits().alias("h"))
    assert [r.h for r in row.collect()] == ["f" * 16, "0" * 15 + "a"]

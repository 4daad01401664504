"""Near duplicates against brute force over full shingle sets."""
import random
import re
import tracemalloc

import numpy as np

from kestrel.llm import near_dedup
from kestrel.llm.components import connected_components
from kestrel.llm.shingles import shingle_sets

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """(id, set size, component) of each row with an id."""
    rows = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (_, s) in enumerate(rows):
        for b in range(a):
            t = rows[b][1]
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                parent[root(a)] = root(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[root(k)] = min(i, low.get(root(k), i))
    return sorted((i, len(s), low[root(k)]) for k, (i, s) in enumerate(rows))


def result(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect() if r["doc_id"] is not None)


def test_shingle_sets():
    texts = ["", "a", "A b", "a  B", "a b c d", "a b c d e", "a b c d e f a b c d e", " x\ty\x0bz\x0cw\rv\n", "é É é É é É"]
    raw = [t.encode() for t in texts]
    prints, n = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(x) for x in raw]))
    assert n.tolist() == [len(shingles(t)) for t in texts]
    ends = np.cumsum(n)
    sets = [frozenset(prints[e - k:e].tolist()) for e, k in zip(ends, n, strict=True)]
    for a, x in enumerate(texts):
        for b, y in enumerate(texts):
            assert len(sets[a] & sets[b]) == len(shingles(x) & shingles(y))


def test_registers_merge():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 1 << 63, k, dtype=np.uint64)) for k in (5000, 300))
    ra, rb, both = (near_dedup.registers(x, np.array([len(x)]))[0] for x in (a, b, np.unique(np.concatenate([a, b]))))
    assert (np.maximum(ra, rb) == both).all()
    assert (near_dedup.registers(np.concatenate([b, a]), np.array([len(b), len(a)])) == np.stack([rb, ra])).all()


def test_likelihood_estimate():
    rng = np.random.default_rng(2)
    found = []
    for _ in range(60):
        a = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        b = np.concatenate([a[:300], rng.integers(0, 1 << 63, 50, dtype=np.uint64)])
        x, y = near_dedup.registers(np.concatenate([a, b]), np.array([400, 350]))
        g, s = (x > y).sum(), (x < y).sum()
        found.append(near_dedup.likely_similarity(*(np.array([v]) for v in (g, s, len(x) - g - s, 400, 350)))[0])
    assert abs(np.mean(found) - 300 / 450) < 0.02


def test_odd_rows(odd_docs, no_docs):
    out = near_dedup.near_duplicates(odd_docs)
    rows = out.collect()
    assert result(out) == brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows if r["doc_id"] is not None)
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None, None]
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_keep_first(odd_docs):
    kept = near_dedup.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    comps = {(r["doc_id"], r["component_id"]) for r in near_dedup.near_duplicates(odd_docs).collect() if r["kept"]}
    assert set(ids) == {i for i, _ in comps if i is not None}
    assert ids.count(3) == 1 and ids.count(4) == 2  # a repeated row stays once, two texts of one id stay both


def test_group_of_copies_with_links_only_through_others(spark):
    """Copies far from the smallest one, chains, and a group whose members are alike but
    below the threshold; small tiles, so that groups are cut into several."""
    rng = random.Random(9)
    vocab = [f"w{k}" for k in range(500)]
    base = [rng.choice(vocab) for _ in range(150)]
    rows = []

    def edited(words, edits):
        out = list(words)
        for _ in range(edits):
            out[rng.randrange(len(out))] = rng.choice(vocab)
        return out

    chain = base
    for i in range(90):
        rows.append((1000 - i, " ".join(edited(base, rng.randrange(0, 9)))))
    for i in range(30):
        chain = edited(chain, 2)
        rows.append((2000 + i, " ".join(chain)))
    half = [rng.choice(vocab) for _ in range(100)]
    for i in range(40):
        rows.append((3000 + i, " ".join(half + [rng.choice(vocab) for _ in range(40)])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert result(near_dedup.near_duplicates(df, tile=1500)) == brute(rows)


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(40)] + [(7, 7)]
    got = dict(connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_in_rounds(spark):
    """With no more than a few edges a task, paths and a large star take several rounds."""
    rng = random.Random(8)
    nodes = [rng.randrange(1 << 40) for _ in range(400)]
    edges = [*zip(nodes[:200], nodes[1:200], strict=False), *((nodes[200], v) for v in nodes[201:390]), (nodes[390], nodes[391])]
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(9)
    want = {v: min(part) for part in (nodes[:200], nodes[200:390], nodes[390:392]) for v in part}
    assert dict(connected_components(df, few=20).collect()) == want == dict(connected_components(df).collect())


def test_few_edges_take_few_tasks(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    sc = spark.sparkContext
    try:
        for k, v in zip(held, ("101", "false"), strict=True):
            spark.conf.set(k, v)
        df = spark.createDataFrame([(i, i + 1) for i in range(300)], "a bigint, b bigint").coalesce(3)
        sc.setJobGroup("few edges", "few edges")
        assert {r["component"] for r in connected_components(df).collect()} == {0}
        tracker = sc.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("few edges") for s in tracker.getJobInfo(j).stageIds}
        assert sum(info.numTasks for s in stages if (info := tracker.getStageInfo(s))) < 101
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in held.items():
            spark.conf.set(k, v)


def test_tile_memory():
    """Beside the one matrix of all pairs a tile holds only rows of others."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    rows = [(k, k, np.unique(np.concatenate([base[:38], rng.integers(0, 1 << 63, 2, dtype=np.uint64)]))) for k in range(2000)]
    tracemalloc.start()
    out = near_dedup._joining_links(rows, 75)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.num_rows == len(rows) - 1
    assert peak < 12 * len(rows) ** 2


def test_a_large_group_is_dealt_out_before_its_sets_are_joined(spark):
    """No exchange of the tiles' rows is by the group alone, but for the totals."""
    rows = spark.createDataFrame([(k, k, 1, bytes(800)) for k in range(40)], "rep bigint, component bigint, group bigint, members binary")
    plan = near_dedup._tiled(rows, 75, 1000)._jdf.queryExecution().executedPlan().toString()
    by_group = [x for x in plan.splitlines() if re.search(r"hashpartitioning\(group#\d+L?, \d+\)", x)]
    assert len(by_group) <= 1 and re.search(r"hashpartitioning\(group#\d+L?, part#\d+", plan)

"""Exact and near dedup against brute force."""
import hashlib
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from feedkit import context
from feedkit.context import StagingScope
from feedkit.llm import common, exact_dedup, near_dedup, signature_trees
from feedkit.llm.graph import components


def flat(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def exact_expected(rows):
    groups = defaultdict(list)
    for n, (doc_id, text) in enumerate(rows):
        groups[flat(text)].append((doc_id is None, doc_id or 0, n, doc_id))
    return sorted((str(r[0]), str(min(groups[flat(r[1])])[3]), len(groups[flat(r[1])]), hashlib.sha256(flat(r[1]).encode()).hexdigest())
                  for r in rows)


def test_exact_groups(make_docs):
    random.seed(3)
    texts = ["", " ", "\n", None, "a b", "a  b", "a\t\x0bb", " a b", "a b ", "ab", "é" * 50, "é" * 49 + "e", "x" * 400, "x" * 399 + "y"]
    texts += ["".join(random.choice("ab ") for _ in range(random.randint(0, 9))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts + texts[:8])] + [(5, "a  b"), (5, "a  b"), (None, "only"), (None, "a b"), (None, "only")]
    got = exact_dedup.exact_dedup(make_docs(rows).repartition(5), block=7).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == exact_expected(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({flat(t) for _, t in rows}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_empty_table(make_docs):
    assert exact_dedup.exact_dedup(make_docs([])).collect() == []


def test_exact_stage_keeps_columns(spark, make_docs):
    docs = make_docs([(2, "a b"), (1, "a  b"), (3, "c")])
    out = exact_dedup.exact_stage(spark, docs, "")
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]


def sets_of(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def near_expected(rows, size, percent):
    sets = [sets_of(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), (True, 0)), (doc_id is None, doc_id or 0))
    return sorted((str(r[0]), len(sets[i]), str(None if low[root(i)][0] else low[root(i)][1])) for i, r in enumerate(rows))


def family(base, copies, most, words):
    out = []
    for _ in range(copies):
        edited = list(base)
        for _ in range(random.randint(0, most)):
            at = random.randrange(len(edited))
            edited[at:at + random.randint(0, 1)] = random.choices(words, k=random.randint(0, 2))
        out.append(" ".join(edited))
    return out


def test_near_groups(make_docs, size=3, percent=85):
    random.seed(11)
    words = ["w%d" % i for i in range(400)]
    texts = ["", None, " \n ", "One", "one", "two words", "TWO  words", "a b c", "É x y z", "é x y z", "long " * 20000]
    for copies, length in ((120, 120), (25, 40), (10, 600)):  # families whose copies lie on either side of the threshold
        texts += family(random.choices(words, k=length), copies, length // 9, words)
    texts += [" ".join(random.choices(words, k=60)) for _ in range(40)]
    rows = [(len(texts) - i, t) for i, t in enumerate(texts)] + [(5, "One"), (5, "One"), (None, "One"), (None, "alone here now")]
    got = near_dedup.near_dedup(make_docs(rows).repartition(4), shingle=size, percent=percent).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == near_expected(rows, size, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.component_id is not None)


def test_near_empty_tables(make_docs):
    assert near_dedup.near_dedup(make_docs([])).collect() == []


def test_near_stage_keeps_one_of_each_group(spark, make_docs):
    base = ["w%d" % i for i in range(80)]
    docs = make_docs([(3, " ".join(base)), (1, " ".join(base[:-1])), (2, "other text of its own here"), (2, "other text of its own here")])
    out = near_dedup.near_stage(spark, docs, "")
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 2]


def test_near_dedup_ends_without_open_nodes(make_docs, monkeypatch):
    staged, stage = [], near_dedup.stage

    def counted(df, name):
        staged.append(name)
        assert staged.count("members") < 10, "the search for open nodes goes round for ever"
        return stage(df, name)

    monkeypatch.setattr(near_dedup, "stage", counted)
    base = ["w%d" % i for i in range(80)]
    for rows in ([], [(i, f"text {i} shares nothing with the others {i * 7}") for i in range(3)],
                 [(1, " ".join(base)), (2, " ".join(base[:-1])), (3, "far away from them all")]):
        got = near_dedup.near_dedup(make_docs(rows)).collect()
        assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == near_expected(rows, 5, 80)
        staged.clear()


def test_signatures_within_the_radius_share_a_bucket():
    import pyarrow as pa

    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**16, near_dedup.CHUNKS * near_dedup.WIDTH, dtype=np.uint16)
    for _ in range(50):
        b = a.copy()
        b[rng.choice(len(b), near_dedup.RADIUS, replace=False)] += 1
        batch = pa.RecordBatch.from_pydict({"sig": [a.tobytes(), b.tobytes()], "node": [1, 2], "n": [9, 9]})
        keys = Counter(k for out in near_dedup._index([batch]) for k in out.column("key").to_pylist())
        assert max(keys.values()) == 2


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 9)] + [(100, 101), (101, 101), (102, 100), (100, 102)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(10)}, **{i: 100 for i in (100, 101, 102)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# -- signature trees ---------------------------------------------------------------------------

def edited_families():
    """Families with links on either side of the threshold, some only by chains of edits that no hub covers."""
    random.seed(13)
    words = ["w%d" % i for i in range(600)]
    texts = ["", None, " \n ", "One", "one", "two words", "TWO  words", "a b c d", "É x y z q", "é x y z q", "long " * 20000]
    for copies, length in ((60, 120), (20, 30), (8, 900)):
        texts += family(random.choices(words, k=length), copies, length // 9, words)
    chain = random.choices(words, k=200)
    for _ in range(30):
        chain = list(chain)
        at = random.randrange(190)
        chain[at:at + 4] = random.choices(words, k=4)
        texts.append(" ".join(chain))
    passage = random.choices(words, k=40)
    texts += [" ".join(random.choices(words, k=50) + passage + random.choices(words, k=50)) for _ in range(30)]
    return texts


@pytest.mark.parametrize("piece_bytes", [signature_trees.PIECE_BYTES, 500])
def test_signature_trees(make_docs, piece_bytes):
    texts = edited_families()
    rows = [(len(texts) - i, t) for i, t in enumerate(texts)] + [(5, "One"), (5, "One"), (None, "One"), (None, "alone here right now")]
    got = signature_trees.jaccard_join(make_docs(rows).repartition(4), size=4, percent=85, piece_bytes=piece_bytes).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == near_expected(rows, 4, 85)


def test_signature_trees_without_hubs(make_docs, monkeypatch):
    """All links found by the trees alone: the hubs' own links are thrown away."""
    links, calls = signature_trees.SignatureJoin.links, []

    def later_links(self, pairs, sets):
        calls.append(1)
        found = links(self, pairs, sets)
        return found.where("false") if len(calls) == 1 else found

    monkeypatch.setattr(signature_trees.SignatureJoin, "links", later_links)
    rows = [(i, t) for i, t in enumerate(edited_families())]
    got = signature_trees.jaccard_join(make_docs(rows), size=4, percent=85, piece_bytes=2000).collect()
    assert len(calls) == 3
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == near_expected(rows, 4, 85)


def test_signature_trees_keep_neither_lowest_hashes_nor_tokens(spark, make_docs):
    """What only the steps before the trees read is gone before the trees are made."""
    words = [f"w{i}" for i in range(60)]
    docs = make_docs([(1, " ".join(words)), (2, " ".join([*words, "x"])), (3, "other words stand here alone")])
    with StagingScope(spark) as scope:
        join = signature_trees.SignatureJoin(docs.selectExpr("doc_id AS rid", "doc_id AS id", "text"), 4, 85)
        assert {tuple(r) for r in join.components().collect()} == {(1, 1), (2, 1)}
        left = {f.name for root in scope.roots for f in Path(root.removeprefix("file:")).glob("*")}
    assert {"folded", "nodes", "candidates", "sets", "regions"} <= left
    assert not {"read", "common", "tokens", "shared"} & left


def lowest_held(rows, size, percent):
    """By node (the smallest id of a set): whether enough of its lowest hashes are in another set."""
    nodes = {}
    for rid, text in sorted(rows):
        shingles = near_dedup.shingle_hashes(text, size, near_dedup._WordHashes())
        if len(shingles):
            nodes.setdefault(shingles.tobytes(), (rid, shingles))
    need = signature_trees.needed
    lows = {rid: s[:len(s) - need(len(s), percent) + need(len(s), signature_trees.EXTRA)].tolist() for rid, s in nodes.values()}
    sets = Counter(e for low in lows.values() for e in low)
    return {rid for rid, s in nodes.values()
            if 100 * sum(sets[e] > 1 for e in lows[rid]) >= signature_trees.EXTRA * need(len(s), percent)}


@pytest.mark.parametrize("block", [1, 700, signature_trees.BLOCK])
def test_signature_trees_candidates_and_tokens(spark, make_docs, block):
    """Blocks of any size leave the candidates of the definition and each one's rarest shared shingles."""
    texts = [t for t in edited_families() if t is None or len(t) < 50_000]
    rows = [(i, t) for i, t in enumerate([*texts, *texts[20:40], "no other text says this"])]
    docs = make_docs(rows).selectExpr("doc_id AS rid", "doc_id AS id", "text")  # in splits by id
    with StagingScope(spark):
        join = signature_trees.SignatureJoin(docs, 4, 85, block=block)
        candidates = {r.node for r in join.candidates.collect()}
        sets = join.sets(join.candidates)
        got = sorted(tuple(r) for r in join.tokens(sets).select("node", "n", "token", "members").collect())
        full = {r.node: np.frombuffer(r.set, np.int64).tolist() for r in sets.collect()}
    # copies of a set are one node: the one that stays is that of the smallest id
    assert candidates == lowest_held(rows, 4, 85) == set(full) and len(candidates) < len(texts)
    count = Counter(e for s in full.values() for e in s)
    first = {}
    for node, s in full.items():
        shared, need = sorted((count[e], e) for e in s if count[e] > 1), signature_trees.needed(len(s), 85)
        first[node] = [e for _, e in shared[:len(shared) - need + 1]] if len(shared) >= need else []
    members = Counter(e for s in first.values() for e in s)
    assert got == sorted((node, len(full[node]), e, members[e]) for node, s in first.items() for e in s if members[e] > 1)


def test_signature_trees_shuffle_hashes_once(make_docs, monkeypatch):
    """Counting a hash and finding who has it take one shuffle of the hashes, also where nothing is broadcast."""
    plans = defaultdict(list)

    def recorded(df, name, write=context.stage):
        plans[name].append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(common, "BROADCAST_NUMBERS", 0)
    for module in (context, common, signature_trees):
        monkeypatch.setattr(module, "stage", recorded)
    rows = [(i, t) for i, t in enumerate(edited_families())]
    got = signature_trees.jaccard_join(make_docs(rows).repartition(4), size=4, percent=85).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == near_expected(rows, 4, 85)
    by_hash = {name: sum(len(re.findall(r"Exchange hashpartitioning\(element#", p)) for p in found) for name, found in plans.items()}
    assert {name: n for name, n in by_hash.items() if n} == {"candidates": 1, "tokens": 1}


def test_signature_trees_a_hash_of_every_text_is_a_row_per_block():
    import pyarrow as pa

    sets = [np.array([5, 7, 100 + i], np.int64) for i in range(40)]
    batch = pa.RecordBatch.from_pydict({"node": list(range(40)), "low": pa.array(sets, pa.list_(pa.int64())), "set": [s.tobytes() for s in sets]})
    lows = [r for out in signature_trees._lowest(60)([batch.slice(0, 13), batch.slice(13)]) for r in out.to_pylist()]
    assert Counter(r["element"] for r in lows if r["known"] < 0) == {5: 2, 7: 2}
    assert Counter(r["element"] for r in lows if r["known"] == 0) == {100 + i: 1 for i in range(40)}
    assert {r["node"]: r["known"] for r in lows if r["known"] > 0} == dict.fromkeys(range(40), 2)
    each = [r for out in signature_trees._elements(60)([batch]) for r in out.to_pylist()]
    assert [r["nodes"] for r in each if r["element"] == 5] == [list(range(20)), list(range(20, 40))]
    assert len(each) == 4 + 40


def test_signature_trees_empty_tables(make_docs):
    assert signature_trees.jaccard_join(make_docs([])).collect() == []
    assert [tuple(r) for r in signature_trees.jaccard_join(make_docs([(1, None), (2, " ")])).collect()] == [(1, 0, 1), (2, 0, 2)]


def test_traversal_finds_all_similar_pairs():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 2**63, rng.integers(20, 60), dtype=np.uint64)
        for _ in range(4):
            kept = base[rng.random(len(base)) > 0.1]
            sets.append(np.unique(np.concatenate([kept, rng.integers(0, 2**63, rng.integers(0, 4), dtype=np.uint64)])))
    bits = np.stack([np.frombuffer(signature_trees.bitmap(s, 9), np.uint64) for s in sets])
    n, one = np.array([len(s) for s in sets]), np.zeros(len(sets), np.int64)
    want = {(i, j) for j in range(len(sets)) for i in range(j)
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    found = {(i, j) for a, b, _ in signature_trees.Tree(bits, n, np.arange(len(sets)), one).pairs(80) for i, j in zip(a.tolist(), b.tolist())}
    assert want and want <= found and len(found) < len(sets) ** 2 / 20
    halves = (np.arange(len(sets)) % 2).astype(np.int64)
    order = np.argsort(halves, kind="stable")
    across = {(order[i], order[j]) for a, b, _ in signature_trees.Tree(bits[order], n[order], np.arange(len(sets)), halves[order]).pairs(80)
              for i, j in zip(a.tolist(), b.tolist())}
    assert {tuple(sorted(map(int, p))) for p in across} == {p for p in found if p[0] % 2 != p[1] % 2}

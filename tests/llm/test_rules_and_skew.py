"""Rules against brute force, hot keys, and the contract columns of the registered queries."""
import hashlib
import heapq
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from oracle_harness import compare, duck

from feedkit.llm import chat, common, exact_dedup, host_rules, line_templates, mixing, near_dedup, registry, secrets
from tests.llm.test_dedup import exact_expected, family, near_expected, sets_of
from tests.llm.test_text_operators import base_spans

SMALL = "/root/testdata/sf0.001"


# -- line templates ----------------------------------------------------------------------------

def recurring_places(texts, rules=line_templates.RULES):
    """The rules of the operator's docstring, over Python sets."""
    lines = {t: [(pos, part.encode().split()) for pos, part in enumerate(t.split("\n")) if part.encode().split()] for t in set(texts)}
    mask = lambda words: tuple(b"<*>" if re.search(rb"[0-9]", w) else w for w in words)
    holders, by_form = defaultdict(set), defaultdict(set)
    for text, parts in lines.items():
        for _, words in parts:
            holders[tuple(words)].add(text)
            if len(words) >= rules.tokens:
                by_form[mask(words)].add(text)
    leaf = lambda form: (len(form), form[:rules.depth])
    in_leaf, forms_of = Counter(), defaultdict(list)
    for form, texts_ in by_form.items():
        in_leaf[leaf(form)] += len(texts_)
        forms_of[leaf(form)].append(form)
    solid = lambda form: sum(t != b"<*>" for t in form[rules.depth:]) >= rules.fixed * (len(form) - rules.depth)
    recurs = set()
    for key, forms in forms_of.items():
        if in_leaf[key] < rules.docs:
            continue
        recurs |= {f for f in forms if solid(f) and len(by_form[f]) >= rules.docs}
        open_ = [f for f in forms if len(forms) > 1 or not solid(f)]
        held = Counter()
        cells = {f: [(at, t) for at, t in enumerate(f) if at >= rules.depth and t != b"<*>"] for f in open_}
        for f in open_:
            held.update({c: len(by_form[f]) for c in cells[f]})
        templates = defaultdict(list)
        n = key[0] - rules.depth
        lead = sum(t != b"<*>" for t in key[1])
        for f in open_:
            kept = [c for c in cells[f] if held[c] >= rules.docs]
            for level in {held[c] for c in kept}:
                cut = frozenset(c for c in kept if held[c] >= level)
                if len(cut) >= rules.fixed * n or (in_leaf[key] >= rules.fill_docs and lead + len(cut) >= rules.fixed * (n + rules.depth)):
                    templates[cut].append((f, level))
        for cut, members in templates.items():
            total = sum(len(by_form[f]) for f, _ in members)
            apart = len(cut) > 1 and len(cut) >= rules.fixed * n
            enough = len(set().union(*(by_form[f] for f, _ in members))) >= rules.docs
            if enough and total >= rules.cohesion * max(level for _, level in members) and (apart or total >= rules.fill * in_leaf[key]):
                recurs |= {f for f, _ in members}
    goes = lambda w: len(holders[tuple(w)]) >= (rules.line_docs if len(w) >= rules.tokens else rules.short_docs) or (
        len(w) >= rules.tokens and mask(w) in recurs)
    return {t: [pos for pos, words in parts if goes(words)] for t, parts in lines.items()}


def check_lines(docs, rows, rules=line_templates.RULES):
    want = recurring_places([t or "" for _, t in rows], rules)
    texts = dict(rows)
    got = line_templates.drop_recurring_lines(docs, rules=rules).collect()
    assert len(got) == len(rows)
    for r in got:
        text = texts[r.doc_id] or ""
        assert r.dropped == want[text], text
        left = "\n".join(part for pos, part in enumerate(text.split("\n")) if pos not in set(want[text]))
        assert r.clean_sha256 == hashlib.sha256((left if want[text] else text).encode()).hexdigest()
        assert (r.n_lines, r.n_dropped) == (len(text.split("\n")), len(want[text]))
    return want


@pytest.mark.parametrize("seed, rules", [(1, line_templates.RULES), (2, line_templates.RULES), (3, line_templates.Rules(depth=2, docs=4, line_docs=3, short_docs=2, fixed=0.6))])
def test_lines_against_brute_force(make_docs, seed, rules):
    random.seed(seed)
    word = lambda n: random.choice("abcdefghijklmnopqrstuvwxyz"[:n]) + random.choice("xyz")
    shapes = [lambda: f"posted by user {word(20)} in {word(5)}", lambda: f"the {word(3)} of {word(3)} and {word(3)}", lambda: "all rights reserved",
              lambda: " ".join(word(26) for _ in range(random.randint(1, 9))), lambda: f"page {random.randint(1, 99)} of {random.randint(1, 99)} {word(2)} {word(9)}",
              lambda: "", lambda: f"{word(2)} {word(2)} {word(2)} {word(2)} {word(2)} {word(2)}"]
    texts = ["\n".join(random.choice(shapes)() for _ in range(random.randint(0, 6))) for _ in range(120)]
    rows = list(enumerate([*texts, *texts[:30], *texts[:10], None, "w " * 30000]))
    want = check_lines(make_docs(rows).repartition(4), rows, rules)
    assert sum(map(len, want.values())) > 50


def test_lines_of_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    check_lines(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_a_text_stored_twice_keeps_its_lines(make_docs):
    text = "a line that only this one text has in it\nand another one that it has and no other"
    rows = [(1, text), (2, text), (3, text), (4, None), (5, "")]
    assert all(r.n_dropped == 0 for r in line_templates.drop_recurring_lines(make_docs(rows)).collect())


# -- host rules --------------------------------------------------------------------------------

def host_documents(hosts):
    """hosts: name to (failing, clean) documents; failing ones fail only a rule that matters on a strict host."""
    random.seed(6)
    clean = lambda: " ".join("w%d" % random.randrange(10**6) for _ in range(25))
    symbols = " ".join(f"#{i}" for i in range(10))
    rows = [(f"{symbols} {clean()}" if i < bad else clean(), "en", host) for host, (bad, good) in hosts.items() for i in range(bad + good)]
    return [(n, *row) for n, row in enumerate(rows)]


def test_small_hosts_shrink_to_the_corpus(make_docs):
    rows = host_documents({f"h{i}": (1, 0) if i < 30 else (0, 1) for i in range(100)})  # 30 percent fail, a document each
    got = host_rules.host_rules(make_docs(rows)).collect()
    assert {r.host_verdict for r in got} == {"ok"} and all(r.kept for r in got)
    assert {round(r.host_rate, 3) for r in got} == {0.3}


def test_host_verdicts_decide(spark, make_docs, tmp_path):
    hosts = {"worst": (60, 1), "bad": (30, 10), "good": (2, 60), "fine": (0, 40), None: (1, 30)}
    rows = host_documents(hosts) + [(900, None, "en", "good"), (901, "few words", "en", "fine")]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    con = duck(str(tmp_path))
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    found = compare(spark, con, str(tmp_path), "op2_host_rules", registry.QUERIES["op2_host_rules"], registry.SQL["op2_host_rules"])
    assert found["status"] == "ok", found
    got = registry.QUERIES["op2_host_rules"](spark, str(tmp_path)).collect()
    source = {r[0]: r[3] for r in rows}
    verdict = {source[r.doc_id]: r.host_verdict for r in got}
    assert verdict == {"worst": "reject", "bad": "strict", "good": "ok", "fine": "ok", None: "ok"}
    kept = Counter(source[r.doc_id] for r in got if r.kept)
    assert kept["worst"] == 0 and kept["bad"] == 10 and kept["good"] == 62 and kept[None] == 31


# -- secrets -----------------------------------------------------------------------------------

def test_ownership_by_owners_and_repositories(make_docs):
    own, spread, copied = "tok_9fK2mQ7xLw83ZpRt", "tok_7hJ4nB6vCx29QwEr", "tok_Ab3dEf6hIj9kLm2nOp"
    rows = [(1, f"see {own} there", "en", "a"), (2, f"and {own}", "de", "a")]
    rows += [(10 + i, f"has {spread} in it", lang, "hot") for i, lang in enumerate(["en", "de", "fr", "es"] * 5)]  # one owner, four repositories
    rows += [(50 + i, f"has {copied}", "en", f"o{i}") for i in range(5)]
    rows += [(80, "key sk_test_51HxQ9aKd82LmVn3RtYw here", "en", "a"), (81, "your-api-key-example-0123456789abcdef", "en", "a"),
             (82, "x" * 400_000 + f" {own} end", "en", "a"), (83, None, None, None)]
    got = {r.doc_id: r for r in secrets.scan_secrets(make_docs(rows).repartition(3)).collect()}
    owned = lambda i: [s for s in got[i].spans if s.kind == 3]
    assert owned(1) and owned(2) and owned(80) and owned(82)[0].start == 400_001
    assert not any(owned(i) for i in [*range(10, 30), *range(50, 55), 81, 83])


# -- mixing ------------------------------------------------------------------------------------

def queue_copies(sizes, goals, passes=3):
    """The copies taken by a heap over finish times, one document at a time."""
    buckets = max(16, int(np.sqrt(len(sizes))))
    target = {g.source: (g.source_size, g.target) for g in goals}
    per_source = defaultdict(list)
    for r in sizes:
        per_source[r.source].append(((((r.place % 2**64) >> 20) % buckets, r.place, r.id is not None, r.id or 0, r.rid), r))
    heap = []
    for source, rows in per_source.items():
        size, goal = target[source]
        upto = 0
        for _, r in sorted(rows, key=lambda x: x[0]):
            upto += r.size
            if goal:
                heap += [((n * size + upto) / goal, r.rid, r.size) for n in range(passes)]
    heapq.heapify(heap)
    left, taken = sum(r.size for r in sizes), Counter()
    while heap:
        _, rid, size = heapq.heappop(heap)
        left -= size
        if left < 0:
            break
        taken[rid] += 1
    return taken


def test_mix_against_a_heap(make_docs):
    random.seed(9)
    rows = [(n, "w " * random.randint(1, 40), "en", random.choice(["a", "a", "a", "b", None, "c"])) for n in range(400)]
    docs = common.numbered(make_docs(rows).repartition(3))
    sizes = mixing.sized(docs.select("rid", "row.doc_id", "row.source", "row.text").toDF("rid", "id", "source", "text"))
    goals = common.stage(mixing.targets(sizes), "targets")
    want = queue_copies(sizes.collect(), goals.collect())
    got = {r.rid: r.copies for r in mixing.mix_copies(sizes, goals).collect()}
    assert got == {rid: want[rid] for rid in got} and len(got) == 400


def test_one_id_in_a_third_of_all_rows(make_docs):
    rows = [(None if n % 3 == 0 else n, f"word {n} " * 3, "en", "ab"[n % 2]) for n in range(3000)]
    got = mixing.mix(make_docs(rows).repartition(4)).collect()
    assert len(got) == 3000
    taken = Counter()
    for r in got:
        taken[r.target] += r.taken
    for target, words in taken.items():
        assert abs(words - target) <= 12


# -- exact and near dedup ----------------------------------------------------------------------

def test_one_block_in_all_texts(make_docs):
    head = "same block " * 20  # 220 characters: several blocks that every text begins with
    rows = [(i, head + f"end {i % 40} " * (i % 5)) for i in range(200)] + [(500, head * 3000), (501, head * 3000), (None, head)]
    got = exact_dedup.exact_dedup(make_docs(rows).repartition(5), block=50).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == exact_expected(rows)


def test_pairs_up_to_the_radius_without_hubs(make_docs, monkeypatch):
    """Signatures 18 to 23 places apart are compared, also where no hub joins them."""
    links, calls = near_dedup._Join.links, []

    def later_links(self, pairs, sets):
        calls.append(1)
        found = links(self, pairs, sets)
        return found.where("false") if len(calls) == 1 else found

    monkeypatch.setattr(near_dedup._Join, "links", later_links)
    random.seed(21)
    some = lambda n: ["w%d" % random.randrange(10**6) for _ in range(n)]
    common_part, hashes, rows = some(115), near_dedup._WordHashes(), []
    hub = common_part + some(20)
    sign = lambda t: near_dedup.signature(near_dedup.shingle_hashes(t, 3, hashes))
    apart = lambda t, u: int((sign(t) != sign(u)).sum())
    rows = [(1000 + i, " ".join(hub[:-1 - i])) for i in range(10)]  # the crowd whose hub all the others meet, and are too far from
    while len(rows) < 10 + 24:
        shared = common_part + some(35)
        pair = [" ".join(shared + some(45)) for _ in range(2)]
        x, y = (sets_of(t, 3) for t in pair)
        of_hub = [t for _, t in rows[:10] if all(apart(t, u) <= near_dedup.RADIUS and 100 * len(sets_of(t, 3) & sets_of(u, 3)) < 60 * len(sets_of(t, 3) | sets_of(u, 3)) for u in pair)]
        if 100 * len(x & y) >= 60 * len(x | y) and 18 <= apart(*pair) <= near_dedup.RADIUS and len(of_hub) == 10:
            rows += [(len(rows), pair[0]), (len(rows) + 1, pair[1])]
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(make_docs(rows).repartition(3), shingle=3, percent=60).collect()}
    assert len(calls) == 2
    assert {i: got[i] for i in range(10, 34)} == {i: i - i % 2 for i in range(10, 34)}


def test_match_beyond_the_broadcast_bound(make_docs, monkeypatch):
    random.seed(12)
    words = ["w%d" % i for i in range(300)]
    rows = list(enumerate(family(random.choices(words, k=90), 30, 9, words) + [" ".join(random.choices(words, k=50)) for _ in range(20)]))
    plain = near_dedup.near_dedup(make_docs(rows), shingle=3, percent=85).collect()
    monkeypatch.setattr(common, "BROADCAST_NUMBERS", -1)  # every match shuffles
    got = near_dedup.near_dedup(make_docs(rows), shingle=3, percent=85).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, plain))
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == near_expected(rows, 3, 85)


# -- chat --------------------------------------------------------------------------------------

def test_rows_without_a_conversation_stay_apart(spark):
    turns = spark.createDataFrame([(None, i, "assistant" if i % 2 else "user", f"text {i}") for i in range(50)] + [(1, 0, "user", "hi"), (1, 1, "assistant", "yo")],
                                  "conv_id long, turn long, role string, text string")
    examples = chat.prefix_examples(turns.repartition(3)).collect()
    assert max(len(r.text) for r in examples if r.conv_id is None) < 60
    back = chat.read_back(chat.prefix_examples(turns)).collect()
    assert sorted(r.turns[0].text for r in back if r.conv_id is None) == sorted(f"text {i}" for i in range(50))
    assert [len(r.turns) for r in back if r.conv_id == 1] == [2]


# -- row numbers and contract columns ----------------------------------------------------------

def test_rows_of_files_are_numbered_in_place(spark, make_docs, tmp_path):
    rows = [(i, f"text {i}") for i in range(100)]
    make_docs(rows).repartition(4).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    numbers = lambda df: {r.rid: r.i for r in common.numbered(df).selectExpr("rid", "row.doc_id AS i").collect()}
    first = numbers(docs)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        again = numbers(docs.where("doc_id % 2 = 0"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(first) == 100 and again == {rid: i for rid, i in first.items() if i % 2 == 0}  # however the files are split
    twice = common.numbered(docs.unionByName(docs))
    assert twice.select("rid").distinct().count() == 200  # no row of a file alone: written once instead
    plan = common.numbered(docs).select("rid", "row.text")._jdf.queryExecution().toString()
    scan = next(part for part in plan.split("ReadSchema: ")[1:] if "text" in part)
    assert scan.startswith("struct<text:string") and "lang" not in scan.split("\n")[0]


CONTRACT = {
    "op1_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op5_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op6_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op7_line_templates": ["doc_id", "n_lines", "n_dropped", "dropped", "clean_sha256"],
    "op8_langid": ["doc_id", "held_out", "lang_pred", "score"],
    "op10_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op11_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op13_signature_trees": ["doc_id", "n_shingles", "component_id"],
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns(spark, name):
    found = registry.QUERIES[name](spark, SMALL)
    assert found.columns[:len(CONTRACT[name])] == CONTRACT[name]
    rows = found.collect()
    given = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    texts = {r.doc_id: r.text or "" for r in given}
    if name == "op11_whitening":
        assert len(rows) == 4 * spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
        return
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        text = texts[r.doc_id]
        if name == "op1_secrets":
            spans = base_spans(text)
            assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest() and set(filter(None, spans.split(","))) <= set(r.spans.split(","))
            assert [r.n_assign, r.n_access, r.n_hex] == [len(re.findall(k, spans)) for k in ("assign:", "access:", "hex:")]
        elif name == "op5_bpe":
            assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        elif name == "op6_mixing":
            assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text)) and 0 <= r.taken <= 3 * r.size
        elif name == "op8_langid":
            assert 0 <= r.score <= 1 and r.lang_pred
    if name in ("op10_near_dedup", "op13_signature_trees"):
        want = near_expected([(i, t) for i, t in texts.items()], *((3, 85) if name == "op10_near_dedup" else (4, 85)))
        assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in rows) == want

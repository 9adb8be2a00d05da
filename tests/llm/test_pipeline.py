"""The pipeline on the small table, each stage against its own rule."""
import re
from collections import Counter

import pytest
from oracle_harness import compare, duck

import corpus_pipeline
from feedkit.llm import registry
from feedkit.llm.common import stage
from tests.llm.test_dedup import near_expected


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, []
    for name, step in corpus_pipeline.STAGES:
        before = docs
        docs = stage(step(spark, before, sf_dir), name)
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "exact_dedup":
            texts = Counter(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in docs.collect())
            assert max(texts.values()) == 1
        if name == "mixing":
            mixed = docs
    assert all(later <= earlier for earlier, later in zip(seen, seen[1:]))
    assert docs.count() == mixed.count() and set(docs.columns) >= {"doc_id", "n_tokens", "ids_sha256"}


def test_registry():
    assert {n.split("_")[0] for n in registry.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(registry.SQL) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_its_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    found = compare(spark, duck(sf_dir), sf_dir, name, registry.QUERIES[name], registry.SQL[name])
    assert found["status"] == "ok", found


def test_pipeline_against_brute_force(spark, make_docs, tmp_path):
    """Every stage's rows against its rule, from a table with clashing columns, copies, nulls and long texts."""
    import random

    random.seed(8)
    words = [f"w{i}" for i in range(3000)]
    plain = [" ".join(random.choices(words, k=random.randint(25, 90))) for _ in range(60)]
    near = [f"{plain[0]} tail{i}" for i in range(6)]
    texts = [*plain, *plain[:10], *[t.replace(" ", "  ") for t in plain[5:9]], *near, None, "", "too short", "again and again " * 30, " ".join(random.choices(words, k=15000))]
    rows = [(i, t, "en", "abc"[i % 3]) for i, t in enumerate(texts)] + [(7, plain[7], "en", "a"), (None, plain[20] + " no id", "en", None)]
    make_docs(rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, held = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, str(tmp_path)), name)
        held[name] = [(r.doc_id, r.text) for r in docs.collect()] if name != "bpe" else docs.collect()
        assert name == "bpe" or docs.columns == columns
    key = lambda rows_: sorted(map(str, rows_))
    good = [(r[0], r[1]) for r in rows if len((r[1] or "").split()) >= 20 and not (r[1] or "").startswith("again")]
    assert key(held["quality_rules"]) == key(good)
    flat = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t)
    first = {}
    for doc_id, text in sorted(good, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(flat(text), doc_id)
    assert key((i, flat(t)) for i, t in held["exact_dedup"]) == key((i, t) for t, i in first.items())
    groups = near_expected(held["exact_dedup"], 5, 80)
    assert sorted(str(i) for i, _ in held["near_dedup"]) == sorted(i for i, _, c in groups if i == c or c == "None")
    taken = Counter(held["mixing"])
    assert set(taken) <= set(held["near_dedup"]) and max(taken.values()) <= 3 and len(taken) > 20
    import public_tokenizers
    import tiktoken

    from feedkit.llm import bpe
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert key((r.doc_id, tuple(r.ids)) for r in held["bpe"]) == key((i, tuple(library.encode_ordinary(t))) for i, t in held["mixing"])
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert key((r.doc_id, r.ids_sha256) for r in whole.collect()) == key((r.doc_id, r.ids_sha256) for r in held["bpe"])


def test_pipeline_of_an_empty_table(spark, make_docs, tmp_path):
    make_docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.collect() == [] and found.columns[:2] == ["doc_id", "n_tokens"]

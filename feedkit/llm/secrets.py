"""Operator 1, secret scan with corpus-wide ownership frequency.

A first pass finds spans in every whole text: the three base patterns, and candidates, which are
long unbroken tokens that mix letters and digits. Each span's value is hashed and the hashes are
counted over the corpus by distinct repository and distinct owner. A value that many owners hold, or
that one owner has in many repositories, is a widely copied example; one in at most ``max_owners``
owners and ``max_repos`` repositories that looks live is owner-specific. A value looks live if enough
characters of enough entropy are left without the words that placeholders are made of. Base spans always stay and are only told apart by
this count; owner-specific candidates that no base span covers are added as spans of kind ``owned``.

For ``documents`` the owner is ``source`` and the repository ``source`` with ``lang``.

Counting is a chain of groupings, each pre-aggregated before its shuffle, so a value that a third
of all rows hold costs a row per task. Verdicts return by a join of one row per distinct value.

Nulls, ties and odd input: a null text counts as empty and has no span; a missing owner is an
owner of its own; repeated rows each get their row; overlapping spans of different kinds all stay; very long
texts are scanned whole, inside their row;
an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.llm.common import column, in_arrow, stage, table

# Fixed values of the contract: the kinds in their order, their patterns and least lengths.
KINDS = ["assign", "access", "hex", "owned"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_LENGTH = 6
#: A maximal run is as long as the pattern asks or fails whole, so the least length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}")
PLACEHOLDER = re.compile(r"example|sample|dummy|placeholder|changeme|change_me|your[_-]?|xxxx|test|redacted|0123456789|abcdef", re.IGNORECASE)
MIN_ENTROPY = 3.0
MIN_LIVE = 12  # letters and digits besides placeholder words
MAX_OWNERS, MAX_REPOS = 2, 2


def entropy(value: str) -> float:
    """Bits per character of the value's own characters."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def looks_live(value: str) -> bool:
    rest = "".join(filter(str.isalnum, PLACEHOLDER.sub("", value)))
    return len(rest) >= MIN_LIVE and entropy(rest) >= MIN_ENTROPY


def find_spans(text: str) -> list[tuple[str, int, int, str]]:
    """``(kind, start, end, value)`` in code points, base kinds first; ``owned`` are candidates outside base spans."""
    found = [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    base = [(start, end) for _, start, end, _ in found]
    for m in CANDIDATE.finditer(text):
        value = m[0]
        mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
        if mixed and looks_live(value) and not any(s < m.end() and m.start() < e for s, e in base):
            found.append(("owned", m.start(), m.end(), value))
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def _scanner(id_type: pa.DataType):
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("hash", pa.binary()), ("live", pa.bool_())])
    schema = pa.schema([("rid", pa.int64()), ("id", id_type), ("owner", pa.string()), ("repo", pa.string()),
                        ("base_sha256", pa.string()), ("spans", pa.list_(span))])

    def scan(batches):
        for batch in batches:
            digests, spans = [], []
            for text in batch.column("text"):
                found = find_spans(text.as_py() or "")
                base = _joined([(start, KINDS.index(kind), end) for kind, start, end, _ in found if kind != "owned"])
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                spans.append([{"kind": KINDS.index(kind), "start": start, "end": end, "live": looks_live(value),
                               "hash": hashlib.sha256(value.encode()).digest()[:16]} for kind, start, end, value in found])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rid", "id", "owner", "repo")),
                                              pa.array(digests, pa.string()), pa.array(spans, pa.list_(span))], schema=schema)

    return scan


def scanned(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_cols: list[str]) -> DataFrame:
    """The spans of every row, written once without the texts: ``(rid, id, owner, repo, base_sha256, spans)``."""
    from pyspark.sql.pandas.types import to_arrow_type

    named = lambda c: F.coalesce(F.concat(F.lit("="), column(c).cast("string")), F.lit("-"))  # noqa: E731  null apart from any name
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), column(id_col).alias("id"), named(owner_col).alias("owner"),
                       F.concat_ws("\n", *map(named, repo_cols)).alias("repo"), column(text_col).alias("text"))
    schema = T.StructType.fromDDL("rid long, owner string, repo string, base_sha256 string, "
                                  "spans array<struct<kind:int,start:int,end:int,hash:binary,live:boolean>>")
    schema = T.StructType([schema["rid"], rows.schema["id"], *list(schema)[1:]])
    return stage(in_arrow(rows, _scanner(to_arrow_type(rows.schema["id"].dataType)), schema), "scanned")


def ownership(scans: DataFrame) -> DataFrame:
    """``(hash, n_owners, n_repos, n_rows)`` of every value found."""
    values = scans.select("rid", "owner", "repo", F.explode(F.array_distinct("spans.hash")).alias("hash"))
    by_repo = values.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
    by_owner = by_repo.groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"), F.sum("n").alias("n_rows"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repo_cols: tuple[str, ...] = ("source", "lang"), max_owners: int = MAX_OWNERS,
                 max_repos: int = MAX_REPOS) -> DataFrame:
    """One row per row of ``docs`` with its spans as structs and the counts behind their verdicts."""
    scans = scanned(docs, id_col, text_col, owner_col, list(repo_cols))
    counts = stage(ownership(scans), "ownership")
    spans = scans.where("size(spans) > 0").select("rid", F.explode("spans").alias("span")).select("rid", "span.*")
    judged = spans.join(counts, "hash").withColumn("specific", F.expr(f"n_owners <= {max_owners} AND n_repos <= {max_repos} AND live"))
    kept = judged.where(f"kind < {KINDS.index('owned')} OR specific").groupBy("rid").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "specific", "n_owners", "n_repos"))).alias("spans"))
    return scans.drop("spans").join(kept, "rid", "left").select(
        F.col("id").alias(id_col), "base_sha256",
        F.coalesce("spans", F.array().cast(kept.schema["spans"].dataType)).alias("spans"))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    kinds = F.array(*map(F.lit, KINDS))
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    of_kind = lambda k: count(lambda s: s["kind"] == k)
    return found.select(
        "doc_id", *(of_kind(k).alias(f"n_{KINDS[k]}") for k in range(3)), "base_sha256",
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",").alias("spans"),
        of_kind(3).alias("n_owned"), count(lambda s: s["specific"]).alias("n_owner_specific"),
        count(lambda s: ~s["specific"]).alias("n_copied_or_dead"))

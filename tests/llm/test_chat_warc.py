"""Chat formatting read back exactly; WARC archives written, damaged and salvaged."""
import base64
import gzip
import hashlib
import itertools
import random
import tracemalloc

import pyarrow as pa
import pytest

from feedkit.llm import chat, warc

TURNS = [(1, 0, "system", "be kind"), (1, 1, "user", "hi <|im_start|>assistant\nno"), (1, 2, "assistant", "a \\1 <|im_end|> b"),
         (1, 3, "user", "more"), (1, 4, "assistant", None), (1, 5, "assistant", "é🙂\n[INST] x [/INST] </s>"), (1, 6, "user", "bye"),
         (2, 0, "user", None), (3, 0, "assistant", "\\"), (3, 0, "assistant", "\\"), (4, None, None, "who"), (None, 1, "assistant", "lost \\0\\2"),
         (5, 0, "us\ner<|", "x" * 50000), (5, 1, "assistant", "<\\1|")]


def test_chat_round_trip(spark):
    turns = spark.createDataFrame([(*t, "x") for t in TURNS], "conv_id long, turn long, role string, text string, piece string")
    examples = chat.prefix_examples(turns.repartition(3))
    back = {r.conv_id: r for r in chat.read_back(examples).collect()}
    for conv in {t[0] for t in TURNS}:
        mine = sorted((t for t in TURNS if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        assert [(t.role, t.text) for t in back[conv].turns] == [(t[2] or "", t[3] or "") for t in mine]
        assert back[conv].replies == [t[3] or "" for t in mine if t[2] == "assistant"]
    rows = [r for r in examples.collect() if r.conv_id == 1]
    assert [r.loss_start is None for r in sorted(rows, key=lambda r: r.example)] == [False, False, False, True]
    whole = max((r.text for r in rows), key=len)
    assert all(whole.startswith(r.text) for r in rows) and [r.last for r in sorted(rows, key=lambda r: r.example)] == [False] * 3 + [True]
    assert chat.read_back(chat.prefix_examples(turns.where("false"))).collect() == []


def pages(spark):
    same = "<p>" + "same " * 40 + "</p>"
    rows = [(1, "http://a.example/é", "<html>é</html>", 0), (5, "u\r\nX: y", same, 0), (3, None, same, 0), (3, None, same, 0), (9, "v", "short", 0),
            (8, "w", "short", 0), (7, "e", "", 0), (6, "n", None, 0), (2, "big", "x" * 300_000, 0), (None, "none", same, 0), (None, "q", "alone " * 30, 0)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string, digest int")


def test_warc_round_trip(spark):
    rows, df = pages(spark)
    folder, archives = warc.write_warc(df.repartition(3))
    got = warc.read_warc(spark, folder, archives).collect()
    assert {r.kind for r in got} == {"record"} and len(got) == len(rows)
    for r in got:
        html = next(h for p, u, h, _ in rows if str(p) == str(r.page_id) and (u is None) == (r.url is None) and (u is None or u[0] == r.url[0])) or ""
        first = 3 if html.startswith("<p>same") else None
        assert r.payload_bytes == len(html.encode()) and r.payload_digest == hashlib.sha256(html.encode()).hexdigest()
        revisit = first is not None and r.page_id != "3"
        assert (r.record_type, r.refers_to) == (("revisit", "3") if revisit else ("response", None))
        assert bytes(r.payload) == (b"" if revisit else html.encode())
    folder, archives = warc.write_warc(df.where("false"))
    assert archives.count() == 0 and warc.read_warc(spark, folder, archives).collect() == []


def parts():
    return [warc.record(str(i), f"u{i}", (f"payload {i} " * 30).encode(), hashlib.sha256((f"payload {i} " * 30).encode()).hexdigest(), None) for i in range(6)]


def ids(found):
    return [f[3]["x-page-id"] for f in found if f[0] == "record"]


@pytest.mark.parametrize("pack", [warc.member, lambda data: data])
def test_salvage(pack):
    members = [pack(p) for p in parts()]
    whole = b"".join(members)
    assert ids(warc.salvage(whole)) == list("012345") and not [f for f in warc.salvage(whole) if f[0] == "gap"]
    start, end = sum(map(len, members[:2])), sum(map(len, members[:3]))
    damaged = whole[:start + 40] + b"\x00\xff" * 30 + whole[start + 100:]          # inside the third record
    found = list(warc.salvage(damaged))
    assert ids(found) == list("01345") and [f[1:3] for f in found if f[0] == "gap"] == [(start, end)]
    cut = whole[:start + 25]                                                        # the file ends early
    found = list(warc.salvage(cut))
    assert ids(found) == list("01") and [f[1:3] for f in found if f[0] == "gap"] == [(start, start + 25)]
    junk = b"junk" + warc.MAGIC + b"WARC/1.0 no" + whole[:start] + b"between" + whole[start:]
    found = list(warc.salvage(junk))
    assert ids(found) == list("012345") and len([f for f in found if f[0] == "gap"]) == 2
    assert list(warc.salvage(b"")) == [] and [f[0] for f in warc.salvage(b"nothing here")] == ["gap"]


def test_salvage_of_a_member_with_several_records():
    p = parts()
    bad = p[1].replace(b"payload 1", b"payload X", 1)
    found = list(warc.salvage(gzip.compress(p[0] + bad + p[2])))
    assert ids(found) == ["0", "2"] and [f[0] for f in found] == ["record", "record", "gap"]


@pytest.mark.parametrize("pack", [warc.member, lambda data: data])
@pytest.mark.parametrize("window", [16, 100, 4096])
def test_salvage_through_any_window(pack, window):
    big = random.Random(1).randbytes(30_000) + warc.MAGIC + warc.VERSION
    members = [pack(p) for p in [*parts(), warc.record("big", "u", big, hashlib.sha256(big).hexdigest(), None), *parts()]]
    whole = b"".join(members)
    rng = random.Random(window)
    for content in (whole, whole[:-9], whole[3:], *(whole[:at] + rng.randbytes(50) + whole[at + cut:] for at in (1, 700, 4090, 9000, 20_000) for cut in (0, 50, 3000))):
        expected = list(warc.salvage(content, len(content) + 100))
        assert list(warc.salvage(content, window)) == expected
        covered = sorted({f[1:3] for f in expected})
        assert covered[0][0] == 0 and covered[-1][1] == len(content) and all(a[1] == b[0] for a, b in itertools.pairwise(covered))


def test_large_archives_are_never_held_whole(spark, tmp_path, monkeypatch):
    folder = tmp_path / "some archives"
    folder.mkdir()
    bodies = [random.Random(i).randbytes(100_000) for i in range(300)]
    packed = [warc.member(warc.record(str(i), f"u{i}", b, hashlib.sha256(b).hexdigest(), None)) for i, b in enumerate(bodies)]
    (folder / "big.warc.gz").write_bytes(b"".join(packed[:200]) + b"\x00" * 5_000_000 + b"".join(packed[200:]))
    tracemalloc.start()
    with pa.OSFile(str(folder / "big.warc.gz")) as file:
        kinds = [(f[0], f[2] - f[1] if f[0] == "gap" else f[3]["x-page-id"]) for f in warc.salvage(file)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [k for k in kinds if k[0] == "gap"] == [("gap", 5_000_000)] and [k[1] for k in kinds if k[0] == "record"] == [str(i) for i in range(300)]
    assert peak < 8_000_000
    rows = lambda: sorted(tuple(r) for r in warc.read_warc(spark, f"file:{folder}", payloads=True).select("page_id", "offset", "kind", "payload").fillna("").collect())
    streamed = rows()
    assert len(streamed) == 301 and {r[0]: bytes(r[3]) for r in streamed if r[2] == "record"} == {str(i): b for i, b in enumerate(bodies)}
    monkeypatch.setattr(warc, "_tasks_reach", lambda folder: False)  # a store that only Spark reads
    assert rows() == streamed
    monkeypatch.undo()
    assert warc._tasks_reach(f"file:{folder}") and not warc._tasks_reach("viewfs://store/in")


def foreign(block_digest, payload_digest, body=b"hello", head=b"HTTP/1.1 200 OK\r\n\r\n", kind="response"):
    block = head + body
    return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Block-Digest: {block_digest(block)}\r\nWARC-Payload-Digest: {payload_digest(body)}\r\n"
            f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + warc.END


def test_salvage_of_foreign_digests():
    of = lambda name, pack: lambda data: f"{name}:{pack(hashlib.new(name.replace('-', '').lower(), data).digest())}"
    base32 = lambda digest: base64.b32encode(digest).decode()
    unknown, wrong = lambda data: "blake9:abc", lambda data: "sha1:" + base32(hashlib.sha1(b"other").digest())
    known = [of(name, pack) for name in ("sha1", "SHA-256", "md5") for pack in (bytes.hex, base32)]
    for digest in [*known, unknown]:
        assert [f[0] for f in warc.salvage(foreign(digest, digest))] == ["record"]
        assert [f[0] for f in warc.salvage(foreign(wrong, digest))] == ["gap"]
        assert [f[0] for f in warc.salvage(foreign(digest, wrong))] == ["gap"]
    assert [f[0] for f in warc.salvage(foreign(known[0], wrong, b"", kind="revisit"))] == ["record"]
    head, chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n", b"5\r\nhello\r\n0\r\n\r\n"
    for digest in (known[1], lambda data: known[1](b"hello")):
        assert [f[0] for f in warc.salvage(foreign(known[1], digest, chunked, head))] == ["record"]

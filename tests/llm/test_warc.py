import base64
import gzip
import hashlib
import io
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shoplens.llm import warc as W
from shoplens.llm.common import scratch_dir

PAGES = "page_id long, url string, html string, record_type string, payload string, kept long, n long"


def archive(spark, rows, min_bytes=0):
    W.register(spark)
    pages = spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], PAGES)
    path = scratch_dir(spark)
    W.with_revisits(pages, min_bytes).write.format("warc").mode("append").save(path)
    return path


ROWS = [(1, "u1", "same"), (2, "u2", "same"), (3, None, None), (4, "u4", ""), (5, "u\r\n5", "é" * 200_000), (6, "u6", "only"),
        (7, "u7", "twice"), (7, "u7", "twice"), (None, "u8", "same"), (None, "u9", "none has an id"), (None, "u9", "none has an id")]


def test_round_trip(spark):
    path = archive(spark, ROWS)
    back = {}
    for r in spark.read.format("warc").option("verify", "true").load(path).collect():
        back.setdefault(r.record_id, []).append(r)
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    for page, _, html in ROWS:
        for r in back[f"<urn:page:{'' if page is None else page}>"]:
            if page is not None:
                assert r.payload_digest == digest(html) and r.payload_length == len((html or "").encode())
            if page is not None and r.record_type == "response":
                assert bytes(r.payload) == (html or "").encode()
    kind = {k: sorted((r.record_type, r.refers_to) for r in v) for k, v in back.items() if k != "<urn:page:>"}
    assert kind["<urn:page:1>"] == [("revisit", "<urn:page:2>")] and kind["<urn:page:2>"] == [("response", None)]
    assert kind["<urn:page:3>"] == [("revisit", "<urn:page:4>")] and kind["<urn:page:4>"] == [("response", None)]
    assert kind["<urn:page:7>"] == [("response", None)] * 2
    nulls = sorted((r.record_type, r.refers_to) for r in back["<urn:page:>"])
    assert nulls == [("response", None), ("response", None), ("revisit", "<urn:page:2>")]


def test_min_bytes(spark):
    path = archive(spark, ROWS, min_bytes=5)
    kinds = {r.record_id: r.record_type for r in spark.read.format("warc").load(path).filter("record_id <> '<urn:page:>'").collect()}
    assert kinds["<urn:page:1>"] == "response" and kinds["<urn:page:3>"] == "response"


def test_empty_table(spark):
    assert spark.read.format("warc").load(archive(spark, [])).collect() == []


def test_filters_are_pushed_and_give_the_same_rows(spark):
    path = archive(spark, ROWS)
    df = spark.read.format("warc").load(path)
    whole = spark.createDataFrame(df.collect(), df.schema)
    for condition in ("record_type = 'revisit'", "record_type in ('response', 'metadata')", "refers_to is not null", "target_uri is null",
                      "content_length > 1000", "content_length <= 90", "record_id like '<urn:page:1%'", "payload_digest = 'x'"):
        got = sorted(r.record_id for r in df.filter(condition).collect())
        assert got == sorted(r.record_id for r in whole.filter(condition).collect())
    plan = df.filter("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (record_type" not in plan


class Spy(io.BytesIO):
    def __init__(self, data):
        super().__init__(data)
        self.n = len(data)

    def size(self):
        return self.n


def records(n):
    html = "<p>" + "text " * 40_000
    return [W.record_bytes("response", f"<r{i}>", "u", "d", html.encode(), len(html), W.base32_sha1(html.encode()), None) for i in range(n)]


@pytest.mark.parametrize("member", [W.gzip_member, gzip.compress])
def test_unwanted_payloads_are_not_decoded(member):
    """With a length field a record is skipped unread; without, it is inflated piece by piece."""
    data = b"".join(member(r) for r in records(5))
    seen = W.Records(Spy(data), True)
    assert [h["warc-record-id"] for h, _ in seen] == [f"<r{i}>" for i in range(5)]
    if member is W.gzip_member:
        assert seen.inflated <= 5 * 2 * W.Records.CHUNK
    blocks = [W.http_payload(b())[0] for _, b in W.Records(Spy(data), True)]
    assert len(set(blocks)) == 1 and blocks[0].startswith(b"<p>text")


@pytest.mark.parametrize("member", [W.gzip_member, gzip.compress])
def test_members_of_several_records(member):
    """Whatever way records are put into members, each is found, its block asked for or not."""
    made = records(3) + [W.record_bytes("response", f"<s{i}>", "u", "d", b"x" * i, i, "D", None) for i in range(40)]
    want = [h["warc-record-id"] for h, _ in W.Records(Spy(b"".join(made)), False)]
    assert len(want) == 43
    for cut in (1, 2, 5, 43):
        data = b"".join(member(b"".join(made[i:i + cut])) for i in range(0, 43, cut))
        assert [h["warc-record-id"] for h, _ in W.Records(Spy(data), True)] == want
        payloads = [len(W.http_payload(b())[0]) if i % 2 else None for i, (_, b) in enumerate(W.Records(Spy(data), True))]
        sizes = [200_003] * 3 + list(range(40))
        assert payloads == [n if i % 2 else None for i, n in enumerate(sizes)]
        with pytest.raises(ValueError):
            [b() for _, b in W.Records(Spy(data[:-60]), True)]


def test_subfolders_and_foreign_archives(spark):
    path = archive(spark, ROWS[:2])
    put = Path(path.removeprefix("file:"))
    small = lambda name: W.record_bytes("response", name, "u", "d", b"x", 1, "D", None)
    (put / "CC-1.warc.gz").write_bytes(gzip.compress(small("<a>") + small("<b>")))
    (put / "deep" / "er").mkdir(parents=True)
    (put / "deep" / "er" / "x.warc").write_bytes(small("<c>"))
    (put / "deep" / f"{'0' * 32}.warc.gz").write_bytes(W.gzip_member(small("<d>")))  # no commits in this folder
    (put / f"{'0' * 32}.warc.gz").write_bytes(W.gzip_member(small("<lost attempt>")))
    (put / "_tmp").mkdir()
    (put / "_tmp" / "y.warc").write_bytes(small("<hidden>"))
    got = sorted(r.record_id for r in spark.read.format("warc").load(path).collect())
    assert got == ["<a>", "<b>", "<c>", "<d>", "<urn:page:1>", "<urn:page:2>"]


def test_plain_files_and_folded_lines():
    data = b"\r\n" + b"".join(records(3)).replace(b"WARC-Date: d", b"WARC-Date: d\r\n more")
    got = list(W.Records(Spy(data), False))
    assert [h["warc-date"] for h, _ in got] == ["d more"] * 3
    assert W.http_payload(got[2][1]())[0].startswith(b"<p>")


def test_damage_is_an_error():
    with pytest.raises(ValueError):
        list(W.Records(Spy(b"no archive"), True))
    whole = W.gzip_member(records(1)[0])
    with pytest.raises(ValueError):
        [b() for _, b in W.Records(Spy(whole[:len(whole) // 2]), True)]


def test_gzip_members_are_read_by_other_tools():
    data = b"".join(W.gzip_member(r) for r in records(2))
    assert gzip.decompress(data) == b"".join(records(2))


def test_base32_column(spark):
    row = spark.range(50).select("id", W.base32_sha1_column(F.col("id").cast("string").cast("binary")).alias("d")).collect()
    assert all(r.d == W.base32_sha1(str(r.id).encode()) for r in row)

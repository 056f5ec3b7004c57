from __future__ import annotations

import base64
import gzip
import hashlib

import pytest
from compare import compare, duck_connect

from skyledger.llm import warc

SF = "/root/testdata/sf0.01"


def test_query_matches_sql(spark):
    report = compare(warc.op9_warc(spark, SF), duck_connect(SF), warc.ORACLE)
    assert report["ok"], report


LONG = "é\r\n0\r\n\r\nWARC/1.1\r\n" * 5000
ROWS = [(1, "http://a/ b\r\nX: y", LONG), (2, None, LONG), (3, "u", None), (4, "u", ""),
        (5, "u", "x" * 99), (6, "u", "x" * 99), (7, "u", "y" * 100), (8, "u", "y" * 100),
        (7, "u", "y" * 100), (None, None, "z" * 150), (9, "u", "z" * 150), (10, "u", "é" * 50),
        (11, "u", "é" * 50), (12, "u", "q" * 8192), (13, "u", "q" * 7000)]


def test_round_trip_and_revisits(spark, scratch_dir):
    df = spark.createDataFrame([(*r, "record", 1) for r in ROWS],
                               "page_id long, url string, html string, record string, digest int")
    warc.write_archive(df, f"{scratch_dir}/w")
    responses, revisits = warc.read_archive(spark, f"{scratch_dir}/w")
    first = {r.record: r for r in responses.collect()}
    payloads = sorted((r.page_id or 0, bytes(r.payload).decode()) for r in first.values())
    assert payloads == sorted((k or 0, t or "") for k, _, t in [
        ROWS[0], *ROWS[2:7], ROWS[10], ROWS[11], ROWS[13], ROWS[14]])
    again = sorted((r.page_id or 0, first[r.refers].page_id) for r in revisits.collect())
    assert again == [(0, 9), (2, 1), (7, 7), (8, 7), (11, 10)]
    assert {r.url for r in first.values() if r.page_id == 1} == {"http://a/%20b%0D%0AX:%20y"}


def test_empty_table(spark, scratch_dir):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archive(none, f"{scratch_dir}/e")
    assert [x.count() for x in warc.read_archive(spark, f"{scratch_dir}/e")] == [0, 0]


def test_segments_out_of_order_in_several_files(spark, scratch_dir, tmp_path):
    payload = b"p" * 30000
    row = {"page_id": 1, "url": "u", "record": "r1", "origin": "r1", "payload": payload,
           "digest": hashlib.sha256(payload).hexdigest()}
    parts = list(warc.records(row))
    assert len(parts) == 4

    def read(chosen):
        folder = tmp_path / str(len(list(tmp_path.iterdir())))
        folder.mkdir()
        for i, p in enumerate(chosen):  # one gzip member a record
            (folder / f"{i}.warc.gz").write_bytes(gzip.compress(p + b"\r\n\r\n"))
        return [bytes(r.payload) for r in warc.read_archive(spark, str(folder))[0].collect()]

    assert read(reversed(parts)) == [payload]
    for broken in (parts[:3], parts[:1] + parts[2:], [*parts, parts[1]]):
        with pytest.raises(Exception, match="not complete"):
            read(broken)


def record(kind, block, **fields):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", *[f"{k.replace('_', '-')}: {v}" for k, v in fields.items()],
             f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def crawl(n):
    """A file as crawlers write it: one member a record, all kinds of records."""
    out = [record("warcinfo", b"software: x\r\n", WARC_Record_ID="<info>")]
    for i in range(n):
        body = f"<p>{i}</p>".encode() * (i + 1)
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out += [record("request", b"GET / HTTP/1.1\r\n\r\n", WARC_Record_ID=f"<q{i}>"),
                record("response", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + body, WARC_Record_ID=f"<r{i}>",
                       WARC_Target_URI=f"http://a/{i}", WARC_Payload_Digest=f"sha1:{sha}")]
    return out + [record("resource", b"a\r\n\r\nb", WARC_Record_ID="<res>"),
                  record("conversion", b"text", warc_record_id="<conv>"),
                  record("revisit", b"HTTP/1.1 200 OK\r\n\r\n", WARC_Record_ID="<v>",
                         WARC_Refers_To="<gone>", WARC_Payload_Digest="sha1:X"),
                  record("x-own", b"", WARC_Record_ID="<own>")]


@pytest.mark.parametrize("form", ["members", "one member", "plain", "padded"])
def test_archives_of_other_writers_are_read_whole(spark, tmp_path, form):
    records = crawl(40)
    data = {"members": b"".join(map(gzip.compress, records)), "one member": gzip.compress(b"".join(records)),
            "plain": b"".join(records), "padded": b"".join(gzip.compress(r) for r in records) + b"\0" * 9}[form]
    (tmp_path / "a.warc.gz").write_bytes(data)
    responses, revisits = warc.read_archive(spark, str(tmp_path))
    got = {r.record: (r.kind, bytes(r.payload)) for r in responses.collect()}
    assert got == {**{f"<r{i}>": ("response", f"<p>{i}</p>".encode() * (i + 1)) for i in range(40)},
                   "<res>": ("resource", b"a\r\n\r\nb"), "<conv>": ("conversion", b"text")}
    assert [tuple(r) for r in revisits.collect()] == [("<v>", None, None, "<gone>", "sha1:X")]
    others = warc.other_records(spark, str(tmp_path)).collect()
    assert sorted(r.kind for r in others) == ["request"] * 40 + ["warcinfo", "x-own"]


@pytest.mark.parametrize("form", ["members", "one member", "plain"])
def test_an_archive_that_is_cut_raises_wherever_it_is_cut(form):
    records = crawl(6)
    data = {"members": b"".join(map(gzip.compress, records)), "one member": gzip.compress(b"".join(records)),
            "plain": b"".join(records)}[form]
    ends = [0]
    for r in records:
        ends.append(ends[-1] + len(gzip.compress(r) if form == "members" else r))
    assert len(list(warc.parse_records(warc.decompressed(data)))) == len(records)
    for at in range(1, len(data), 7):
        if form != "one member" and at in ends:
            assert len(list(warc.parse_records(warc.decompressed(data[:at])))) == ends.index(at)
            continue
        with pytest.raises(ValueError):
            list(warc.parse_records(warc.decompressed(data[:at])))


def test_small_pieces_give_the_same_records(monkeypatch):
    data = b"".join(map(gzip.compress, crawl(30)))
    whole = list(warc.parse_records(warc.decompressed(data)))
    monkeypatch.setattr(warc, "PIECE", 7)
    assert list(warc.parse_records(warc.decompressed(data))) == whole


def test_digests_of_other_kinds():
    body = b"body"
    for name in ("sha1", "md5", "sha256"):
        raw = hashlib.new(name, body).digest()
        for value in (raw.hex(), raw.hex().upper(), base64.b32encode(raw).decode()):
            assert warc.matches(f"{name}:{value}", b"other", body)
        assert not warc.matches(f"{name}:{raw.hex()}", b"other")
    assert warc.matches("unheard-of:1", body)


def test_framing():
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for payload in (b"", b"a", b"b" * 5000):
        assert warc.unchunked(warc.chunked(payload)) == payload
    with pytest.raises(ValueError):
        warc.unchunked(b"3\r\nabcd\r\n0\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc.parse_records(b"WARC/1.1\r\nWARC-Type: x\r\nWARC-Record-ID: a\r\n"
                                b"Content-Length: 9\r\n\r\nshort\r\n\r\n"))


@pytest.fixture()
def scratch_dir(tmp_path):
    return str(tmp_path)

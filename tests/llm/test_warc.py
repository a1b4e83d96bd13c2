import base64
import hashlib
import struct

import pytest
import zstandard

from eventide.llm import warc

PAGES = "page_id long, url string, html string, payload binary"


def sha(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def brute(rows, least=0):
    out = []
    for page, _, html, _ in rows:
        html = html or ""
        same = [p for p, _, h, _ in rows if (h or "") == html and p is not None]
        top = max(same, default=None)
        again = len(html.encode()) >= least and top is not None and page != top
        out.append((page, len(html.encode()), sha(html), "revisit" if again else "response", top if again else None))
    return sorted(out, key=repr)


def pages():
    rows = [(i, f"https://a.example/{i}", f"<p>page {i % 23} {'é' * (i % 5)}</p>" * (i % 7), None) for i in range(120)]
    rows += [(200, None, None, None), (201, "x y\r\nz: 1", "", None), (None, "u", "alone", None), (None, None, "<p>", None),
             (202, "v", "<p>", None), (202, "v", "<p>", None), (203, "w", "word " * 200_000, None)]
    return rows


@pytest.mark.parametrize("least, per_file", [(0, 4096), (20, 7)])
def test_round_trip(spark, tmp_path, least, per_file):
    rows = pages()
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    path = f"{tmp_path}/a"
    warc.write_archives(df, path, min_revisit=least, records_per_archive=per_file)
    got = warc.read_archives(spark, path).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got),
                  key=repr) == brute(rows, least)
    html = {r[0]: r[2] or "" for r in rows}
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.page_id is not None and r.payload is not None:
            assert bytes(r.payload).decode() == html[r.page_id]
    urls = {r.page_id: r.url for r in got}
    assert urls[200] is None and urls[201] == "x%20y%0D%0Az:%201" and urls[5] == "https://a.example/5"


def test_archives_start_with_the_dictionary_and_have_a_frame_for_each_record(spark, tmp_path):
    df = spark.createDataFrame(pages(), PAGES).repartition(2)
    path = tmp_path / "a"
    warc.write_archives(df, str(path), records_per_archive=10)
    files = [p.read_bytes() for p in path.glob("part-*")]
    assert len(files) >= 12 and sum(len(list(warc.read_archive(b))) for b in files) == len(pages())
    for data in files:
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.DICT_MAGIC and size > 0
        # any zstandard reader that is given the dictionary gets all records, skippable frames aside
        d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
        whole = d.stream_reader(data[8 + size:], read_across_frames=True).read()
        assert whole.count(b"WARC/1.1\r\n") == len(list(warc.read_archive(data))) <= 10


def test_empty_table(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], PAGES), f"{tmp_path}/a")
    assert warc.read_archives(spark, f"{tmp_path}/a").count() == 0


def record(**kw):
    args = {"page_id": 1, "url": "http://u", "payload": b"<p>x</p>", "refers_to": None, "date": "2024-01-01T00:00:00Z"}
    return warc.make_record(**{**args, **kw})


def test_reader_takes_plain_packed_and_no_dictionary():
    text = [f"record {i} of some html page <p>{i}</p>".encode() * 5 for i in range(200)]
    made = zstandard.train_dictionary(2048, text)
    records = [record(page_id=i, payload=t) for i, t in enumerate(text)]
    write = zstandard.ZstdCompressor(dict_data=made)
    frames = b"".join(write.compress(r) for r in records)
    plain = warc.dictionary_frame(made.as_bytes())
    packed = warc.dictionary_frame(zstandard.compress(made.as_bytes()))
    for lead in (plain, packed):
        assert [r for _, r in warc.read_archive(lead + frames)] == records
    bare = b"".join(zstandard.compress(r) for r in records)
    other = struct.pack("<II", 0x184D2A53, 3) + b"abc"
    assert [r for _, r in warc.read_archive(bare + other)] == records
    with pytest.raises(warc.ArchiveError):
        list(warc.read_archive(frames[:4000]))


def test_frame_lengths_for_all_kinds_of_frames():
    for data in (b"", b"a", b"a" * 100_000, bytes(range(256)) * 3000):
        for size in (True, False):
            for check in (True, False):
                frame = zstandard.ZstdCompressor(write_content_size=size, write_checksum=check).compress(data)
                assert warc.frame_end(frame + b"rest", 0) == len(frame)
                for cut in (5, len(frame) - 1):
                    with pytest.raises(warc.ArchiveError):
                        warc.frame_end(frame[:cut], 0)


def test_bad_archives_are_refused():
    frame = zstandard.ZstdCompressor(write_checksum=True).compress(record())
    for bad in (b"abc", b"no zstandard frame", frame[:-1], frame[:-1] + bytes([frame[-1] ^ 1]),
                frame + warc.dictionary_frame(b"x" * 10), struct.pack("<II", warc.DICT_MAGIC, 99)):
        with pytest.raises(warc.ArchiveError):
            list(warc.read_archive(bad))


@pytest.mark.parametrize("old, new", [
    (b"WARC/1.1", b"WARK/1.1"), (b"WARC-Type: ", b"WARC-Type "), (b"WARC-Type: response", b"WARC-Type: other"),
    (b"WARC-Date", b"X-Date"), (b"msgtype=response\r\nContent-Length: ", b"msgtype=response\r\nContent-Length: 1"),
    (b"<p>x", b"<p>y"), (b"Payload-Digest: sha1:", b"Payload-Digest: sha1:A"), (b"\r\n\r\n", b"\r\n"),
    (b"WARC-Date", b"WARC-Type: response\r\nWARC-Date"), (b"</p>\r\n\r\n", b"</p>\r\n\r\nx")])
def test_bad_records_are_refused(old, new):
    assert warc.parse_record(record())["payload"] == b"<p>x</p>"
    broken = record().replace(old, new)
    assert broken != record()
    with pytest.raises(warc.ArchiveError):
        warc.parse_record(broken)


def test_revisits_state_the_whole_payload():
    r = warc.parse_record(record(refers_to=9))
    assert (r["record_type"], r["refers_to"], r["payload_bytes"], r["payload"]) == ("revisit", 9, 8, None)
    assert r["payload_digest"] == sha("<p>x</p>")


def foreign(kind, block, rid="<urn:uuid:0f5c-1>", version="WARC/1.0", **fields):
    lines = {"WARC-Type": kind, "WARC-Record-ID": rid, "WARC-Date": "2024-01-01T00:00:00Z", **fields,
             "Content-Length": str(len(block))}
    return (version + "\r\n" + "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in lines.items())).encode() \
        + b"\r\n" + block + b"\r\n\r\n"


def test_records_of_other_writers(spark, tmp_path):
    """Record types, versions, ids, digests and frames that write_archives does not make."""
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<p>hello</p>"
    sha = hashlib.sha256(b"<p>hello</p>").hexdigest()
    records = [
        foreign("warcinfo", b"software: x\r\n", Content_Type="application/warc-fields"),
        foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", WARC_Concurrent_To="<urn:uuid:1>"),
        foreign("response", http, rid="<urn:uuid:aa>", WARC_Target_URI="http://a/",
                Content_Type="application/http; msgtype=response", WARC_Payload_Digest="sha256:" + sha),
        foreign("response", http, version="WARC/1.1", X="folded\r\n line"),
        foreign("resource", b"plain", Content_Type="text/plain", WARC_Block_Digest="md5:" + hashlib.md5(b"plain").hexdigest()),
        foreign("metadata", b"", WARC_Refers_To="<urn:uuid:aa>"),
        foreign("revisit", b"", WARC_Refers_To_Target_URI="http://a/"),
        foreign("revisit", http[:-12], WARC_Refers_To="<urn:uuid:aa>"),
        foreign("response", http[:-3], WARC_Truncated="length", WARC_Payload_Digest="sha256:" + sha),
    ]
    plain = zstandard.ZstdCompressor(write_content_size=False)
    (tmp_path / "f.warc.zst").write_bytes(b"".join(plain.compress(r) for r in records))
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert [r.record_type for r in rows] == ["warcinfo", "request", "response", "response", "resource", "metadata",
                                             "revisit", "revisit", "response"]
    assert rows[2].payload == b"<p>hello</p>" == rows[3].payload and rows[2].payload_digest == "sha256:" + sha
    assert rows[3].payload_digest == warc.digest(b"<p>hello</p>") and rows[4].payload == b"plain"
    assert (rows[2].record_id, rows[5].refers_to_id, rows[2].page_id) == ("urn:uuid:aa", "urn:uuid:aa", None)
    assert rows[8].payload == b"<p>hello<"
    for bad in (foreign("response", http, WARC_Payload_Digest="sha256:" + sha[::-1]),
                foreign("resource", b"x", WARC_Block_Digest="sha1:AAAA"), foreign("response", b"no header"),
                foreign("revisit", b""), foreign("warcinfo", b"", Warc_Type="again")):
        with pytest.raises(warc.ArchiveError):
            warc.parse_record(bad)
    cut = plain.compress(records[0])
    with pytest.raises(warc.ArchiveError):
        list(warc.read_archive(cut[:-3]))


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    """Pages that hardly compress: no file much above the bound, and the round trip whole."""
    df = spark.range(400).selectExpr("id as page_id", "'http://a/' as url",
                                     "array_join(transform(sequence(1, 300), i -> md5(cast(id * 1000 + i as string))), '') as html")
    warc.write_archives(df.coalesce(1), str(tmp_path / "b"), archive_bytes=1 << 20, dictionary=b"")
    sizes = [p.stat().st_size for p in (tmp_path / "b").glob("part-*")]
    assert len(sizes) >= 2 and max(sizes) < (1 << 20) + warc.PARTS * 10_000
    assert warc.read_archives(spark, str(tmp_path / "b")).count() == 400

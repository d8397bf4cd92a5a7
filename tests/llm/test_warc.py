import struct

import pytest
import zstandard

from ledgerloom.llm import warc

SCHEMA = "page_id bigint, url string, html string, file string, _key int"


def written(spark, rows, **options):
    folder = warc.archive_folder(spark)
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    archives = warc.write_warc(pages, folder, **options)
    return warc.read_warc(spark, folder, archives).withColumns(
        {"page_id": warc.id_from_record("record_id"), "first": warc.id_from_record("refers_to")}
    )


def test_round_trip(spark):
    big = "é" * 400_000
    rows = [
        (1, "http://a/", "<p>one</p>"), (2, "http://b/", "<p>one</p>"), (3, None, None), (4, "x\r\ny", ""),
        (5, "http://c/", big), (5, "http://c/", big), (None, "http://d/", "alone"), (None, "u", "<p>one</p>"),
        (-6, "http://e/%41", "\r\n\r\nWARC/1.1\r\n"),
    ]
    out = written(spark, rows).collect()
    assert all(r.error is None for r in out) and len(out) == len(rows)
    of = lambda i: [r for r in out if r.page_id == i]
    assert [(r.record_type, r.first) for r in of(1)] == [("revisit", 2)]
    assert of(2)[0].payload == b"<p>one</p>" and of(2)[0].first is None
    assert [(r.record_type, r.first) for r in of(3)] == [("revisit", 4)]
    assert of(4)[0].payload == b"" and of(4)[0].payload_bytes == 0
    assert [r.payload for r in of(5)] == [big.encode()] * 2
    assert of(-6)[0].payload == b"\r\n\r\nWARC/1.1\r\n"
    assert sorted((r.record_type, r.first or 0) for r in of(None)) == [("response", 0), ("revisit", 2)]
    assert all(r.payload_bytes == len(r.payload) for r in out if r.payload is not None)


def test_short_payloads_are_all_responses(spark):
    out = written(spark, [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "xyz"), (4, "d", "xyz")], min_bytes=3)
    assert sorted((r.page_id, r.record_type) for r in out.collect()) == [
        (1, "response"), (2, "response"), (3, "revisit"), (4, "response")
    ]


def test_no_rows(spark):
    assert written(spark, []).count() == 0


def archive(n=20):
    payloads = [f"<p>payload {i}</p>".encode() * 9 for i in range(n)]
    return warc.archive_bytes([warc.page_record(i, "u", p, None) for i, p in enumerate(payloads)], payloads)


def test_one_frame_per_record_after_the_dictionary():
    data = archive()
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D
    offsets = [offset for offset, _ in warc.read_archive(data)]
    assert len(offsets) == 20 and offsets[0] == 8 + size
    assert all(data[o : o + 4] == b"\x28\xb5\x2f\xfd" for o in offsets)


def test_without_dictionary_frame():
    record = warc.page_record(1, "u", b"abc", None)
    assert len(list(warc.read_archive(zstandard.ZstdCompressor().compress(record)))) == 1


@pytest.mark.parametrize("data", [archive()[:-3], archive()[:5], archive()[:40], b"junk that is no frame", archive() + b"xx"])
def test_broken_archives(data):
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(data))


@pytest.mark.parametrize(
    "old, new",
    [(b"WARC/1.1", b"WARC/9.1"), (b"WARC-Date", b"WARC-Dato"), (b"Content-Length: 8", b"Content-Length: 9"),
     (b"WARC-Type: ", b"WARC-Type "), (b"\r\n\r\n", b"\r\n")],
)
def test_broken_records(old, new):
    record = warc.page_record(1, "u", b"abc", None)
    assert old in record
    with pytest.raises(warc.WarcError):
        warc.parse_record(record.replace(old, new) if old != b"\r\n\r\n" else record[:-2])


def test_a_wrong_digest_is_an_error():
    record = warc.parse_record(warc.page_record(1, "u", b"abc", None))
    assert warc._record_row("f", 0, record)["error"] is None
    wrong = warc.Record(record.headers, record.block.replace(b"abc", b"abd"))
    assert warc._record_row("f", 0, wrong)["error"] == "payload digest does not fit"


def test_archives_lost_or_cut_are_reported(spark, tmp_path):
    pages = spark.range(40).selectExpr("id page_id", "'u' url", "concat('page ', id) html")
    folder = str(tmp_path / "warc")
    archives = warc.write_warc(pages, folder)
    listed = archives.collect()
    assert sum(r.records for r in listed) == 40
    assert warc.read_warc(spark, folder, archives).where("error IS NOT NULL").count() == 0
    more = archives.selectExpr("file", "records + 1 AS records").unionByName(
        spark.createDataFrame([("lost.warc.zst", 5)], "file string, records bigint")
    )
    found = warc.read_warc(spark, folder, more)
    errors = sorted(r.error for r in found.where("error IS NOT NULL").collect())
    assert errors == sorted([f"{r.records} of {r.records + 1} records" for r in listed] + ["the archive is not there"])
    assert found.where("error IS NULL").count() == 40


def test_a_bare_path_means_the_default_file_system(spark, tmp_path):
    """Executors get the address that Spark's readers use, not a path on their own disk."""
    bare = str(tmp_path / "bare")
    assert warc._whole_address(spark, bare) == f"file:{bare}"
    assert warc._whole_address(spark, f"file:{bare}") == f"file:{bare}"
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://cluster/")
    conf.set("fs.viewfs.mounttable.cluster.link./data", f"file:{tmp_path}")
    try:
        assert warc._whole_address(spark, "/data/warc") == "viewfs://cluster/data/warc"
    finally:
        conf.set("fs.defaultFS", before or "file:///")


def test_extra_columns_are_not_written(spark, tmp_path):
    pages = spark.range(3).selectExpr("id page_id", "'u' url", "'x' html", "'a' record_type", "1 records", "'f' file", "'k' _key")
    archives = warc.write_warc(pages, str(tmp_path / "w"))
    kinds = sorted(r.record_type for r in warc.read_warc(spark, str(tmp_path / "w"), archives).collect())
    assert kinds == ["response", "revisit", "revisit"]

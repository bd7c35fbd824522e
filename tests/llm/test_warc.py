import base64
import glob
import hashlib
import os
import sys

import zstandard

sys.path.insert(0, os.path.dirname(__file__))
from helpers import prose  # noqa: E402

from wardflow.llm import warc  # noqa: E402

SCHEMA = "page_id long, url string, html string, payload string, row long, id string"


def pages(spark):
    rows = [(3, "http://a.example/x y", "<p>one</p>"), (1, "http://b.example/", "<p>one</p>"), (2, None, None), (4, "u", ""),
            (5, "u", prose(1, 30_000)), (6, "bad\r\nurl", "<p>two é</p>"), (6, "bad\r\nurl", "<p>two é</p>"), (None, "n", "<p>two é</p>"),
            (None, "n", "only"), (7, "w", "a\r\n\r\nb")]
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA), rows


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_round_trip(spark):
    frame, rows = pages(spark)
    got = warc.read_records(warc.write_bundles(frame, frame_bytes=200, bundle_bytes=300)).collect()
    assert len(got) == len(rows) and len({r.record_id for r in got}) == len(rows)
    texts = {}
    for i, _, t in rows:
        texts.setdefault(t or "", []).append(i)
    for r in got:
        page = None if r.page is None else int(r.page)
        text = next(t for t, ids in texts.items() if page in ids and digest(t) == r.payload_digest)
        assert r.payload_bytes == len(text.encode())
        least = min((i for i in texts[text] if i is not None), default=None)
        if r.record_type == "response":
            assert page == least and bytes(r.payload).decode() == text and r.refers_to_id is None
        else:
            assert r.refers_to_page == str(least) and bytes(r.payload) == b""
            assert r.refers_to_id in {x.record_id for x in got if x.record_type == "response"}
    for t, ids in texts.items():
        assert sum(r.record_type == "response" for r in got if r.payload_digest == digest(t)) == 1
    small = warc.read_records(warc.write_bundles(frame, min_revisit_bytes=11)).collect()
    assert sum(r.record_type == "revisit" for r in small) == 2  # only the payload of 12 bytes is long enough


def test_index_and_files(spark, tmp_dir):
    frame, rows = pages(spark)
    bundles = warc.write_bundles(frame, frame_bytes=200, bundle_bytes=300)
    for b in bundles.collect():
        table = warc.seek_table(bytes(b.content))
        assert len(table) == b.frames
        whole = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True)
        text = b"".join(warc.read_frame(bytes(b.content), f) for f in table)
        assert whole.decompress(bytes(b.content)) == text
        for r in b.records:  # the offsets are those inside the frame
            data = warc.read_frame(bytes(b.content), table[r.frame])
            head, _, _, end = warc.parse_record(data, r.offset)
            assert head["WARC-Record-ID"] == f"<{r.record_id}>" and end - r.offset == r.length
    some = warc.read_records(bundles).where("page in ('1', '5', '2')").select("record_id")
    got = {r.page for r in warc.fetch(bundles, some.union(some)).collect()}
    assert got == {"1", "5", "2"}
    assert warc.export_files(bundles, f"{tmp_dir}/out").count() == bundles.count()
    files = glob.glob(f"{tmp_dir}/out/*")
    assert len(files) == bundles.count() and all(f.endswith(".warc.zst") for f in files)
    assert sum(len(warc.seek_table(open(f, "rb").read())) for f in files) == bundles.agg({"frames": "sum"}).first()[0]


def test_empty(spark):
    assert warc.read_records(warc.write_bundles(spark.createDataFrame([], SCHEMA))).count() == 0


def test_one_payload_on_most_pages(spark):
    """Copies of one payload are spread over tasks, and refer to the least id."""
    rows = [(i, f"u{i}", "same body" if i % 3 else f"own {i}") for i in range(600)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    got = warc.read_records(warc.write_bundles(frame)).collect()
    assert {(r.record_type, r.refers_to_page) for r in got if int(r.page) % 3} == {("response", None), ("revisit", "1")}
    assert sum(r.record_type == "revisit" for r in got) == 399 and len(got) == 600

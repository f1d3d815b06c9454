import base64
import hashlib
import io
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from blotter.llm.warc_bundles import fetch, page_of, read_bundles, record_id, seek_table, write_bundles

SCHEMA = "page_id long, url string, html string"


def brute(rows, least=0):
    out = []
    for k, (i, _, h) in enumerate(rows):
        b = (h or "").encode()
        same = [(j, x) for j, (x, _, g) in enumerate(rows) if (g or "").encode() == b and len(b) >= least]
        ids = [x for _, x in same if x is not None]
        head = max(ids) if ids else None
        d = base64.b32encode(hashlib.sha1(b).digest()).decode()
        revisit = len(same) > 1 and i != head
        out.append((i, len(b), d, "revisit" if revisit else "response", head if revisit else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def pages():
    rng = random.Random(8)
    bodies = [f"<p>{k} é\r\n\r\nWARC/1.1 {'x' * rng.randint(0, 4000)}</p>" for k in range(40)]
    rows = [(i, f"http://h/{i}?a=b c\r\nX: y", rng.choice(bodies)) for i in range(300)]
    return rows + [(400, None, None), (401, "u", ""), (-5, "u", "negative"), (402, "u", "big" * 400_000), (403, "u", "\u0000퟿")]


@pytest.mark.parametrize("least,frame,size", [(0, 8 << 10, 30 << 10), (2000, 1, 1), (0, 256 << 10, 16 << 20)])
def test_round_trip(spark, tmp_path, least, frame, size):
    rows = pages()
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", copy int").repartition(3)
    path = str(tmp_path / "out")
    write_bundles(df, path, min_revisit_bytes=least, frame_bytes=frame, bundle_bytes=size)
    back = read_bundles(spark, path).cache()
    assert got(back) == brute(rows, least)
    payloads = {r.page_id: r.payload for r in back.collect() if r.payload is not None}
    want = {i: (h or "").encode() for i, _, h in rows}
    assert all(want[i] == p for i, p in payloads.items())
    ids = back.filter(F.col("page_id") % 7 == 0).select("record_id")
    some = fetch(spark, path, back.select("record_id", "bundle", "frame", "offset"), ids)
    assert sorted(map(str, some.collect())) == sorted(map(str, back.filter(F.col("page_id") % 7 == 0).collect()))


def test_files_are_plain_seekable_zstandard(spark, tmp_path):
    path = tmp_path / "out"
    write_bundles(spark.createDataFrame(pages(), SCHEMA).coalesce(1), str(path), frame_bytes=4096, bundle_bytes=1 << 30)
    (file,) = path.glob("part-*")
    data = file.read_bytes()
    table = seek_table(data)
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert len(table) > 10 and len(whole) == sum(t[2] for t in table) and whole.count(b"WARC-Record-ID: ") == len(pages())


def test_repeated_rows_null_ids_and_empty(spark, tmp_path):
    rows = [(1, "u", "same"), (1, "u", "same"), (None, "u", "same"), (None, "u", "alone"), (2, "u", "x")]
    write_bundles(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "a"))
    out = got(read_bundles(spark, str(tmp_path / "a")))
    assert [r[3:] for r in out if r[0] == 1] == [("response", None), ("revisit", 1)]
    assert sorted(str(r[3:]) for r in out if r[0] is None) == ["('response', None)", "('revisit', 1)"]
    write_bundles(spark.createDataFrame([], SCHEMA), str(tmp_path / "b"))
    assert read_bundles(spark, str(tmp_path / "b")).filter("page_id is not null").count() == 0


def test_record_ids_name_their_page():
    for i in (0, 1, -1, 2 ** 62, -(2 ** 63), None):
        assert page_of(record_id(i, 12345)) == i

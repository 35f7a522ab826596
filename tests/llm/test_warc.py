import hashlib
import struct
from collections import Counter

import pyarrow.fs
import pytest
import zstandard

from loanlens import scratch
from loanlens.llm import warc
from loanlens.llm.store import Store

SCHEMA = "page_id long, url string, html string, record_type string, bundle int"


def rows():
    big, other = "é<p>" * 500, "x" * 1000
    out = [(i, f"http://a.example/{i}", big if i % 3 == 0 else f"page {i}", None, 1) for i in range(30)]
    out += [(40, None, other, None, None), (41, "http://evil\r\nX: y/ z", other, "r", None), (42, "u", "y" * 999, None, None), (43, "u", "y" * 999, None, None)]
    out += [(44, "u", None, None, None), (45, "u", "", None, None), (None, "u", big, None, None), (None, "u", "z" * 5000, None, None), (None, "u", "z" * 5000, None, None)]
    return out + [(46, "u", "w" * 2000, None, None), (46, "u", "w" * 2000, None, None), (47, "u", "long\r\n\r\n" * 400_000, None, None)]


def expected():
    payloads = [(r[0], (r[2] or "").encode()) for r in rows()]
    out = Counter()
    for page, p in payloads:
        same = [i for i, q in payloads if q == p and i is not None]
        again = len(p) >= 1000 and same and page != max(same)
        out[page, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", max(same) if again else None] += 1
    return out


@pytest.mark.parametrize("most", [100_000, -1])
def test_round_trip(spark, monkeypatch, most):
    monkeypatch.setattr(warc, "FRAME_BYTES", 3000)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 2000)
    monkeypatch.setattr(warc, "BROADCAST_PAYLOADS", most)
    folder = scratch.new_folder(spark, "bundles")
    index = Store(spark).put("index", warc.write_bundles(spark.createDataFrame(rows(), SCHEMA).repartition(3), folder))
    assert Counter(tuple(r) for r in warc.read_bundles(index).collect()) == expected()
    assert index.count() == len(rows()) and index.select("bundle").distinct().count() > 1
    # Any Zstandard reader can read a whole bundle: the seek table is a skippable frame.
    where = index.first().bundle
    files, path = pyarrow.fs.FileSystem.from_uri(where)
    data = files.open_input_file(path).read()
    assert struct.unpack("<I", data[-4:])[0] == warc.SEEKABLE_MAGIC
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    mine = index.where(index.bundle == where)
    assert plain.count(b"WARC/1.1\r\n") == mine.count() and len(plain) == mine.groupBy().sum("length").first()[0]
    reader = warc.Reader(where)
    assert b"".join(reader.frame(k) for k in range(len(reader.places))) == plain


def test_damage_is_noticed():
    row = {"page_id": 1, "url": None, "payload": b"abc", "bytes": 3, "digest": hashlib.sha1(b"abc").hexdigest(), "record_type": "response", "refers_to": None}
    data = warc.record(row)
    assert warc.parse(data)["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"abc", b"abd"))


def test_empty_table(spark):
    index = Store(spark).put("index", warc.write_bundles(spark.createDataFrame([], SCHEMA), scratch.new_folder(spark, "bundles")))
    assert warc.read_bundles(index).collect() == []

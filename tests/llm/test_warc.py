"""Archives of pages: what is read back, the same bytes again, and nothing left of attempts that do not count."""

import base64
import glob
import gzip
import hashlib
import json

import pytest

from citeloom.llm import queries, warc
from citeloom.llm.common import table_path


def _digest(raw):
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def _want(rows, least=0):
    payload = [(i, (h or "").encode()) for i, _, h in rows]
    last = {}
    for i, raw in payload:
        if i is not None and len(raw) >= least:
            last[raw] = max(i, last.get(raw, i))
    out = []
    for i, raw in payload:
        to = last.get(raw)
        again = to is not None and i != to
        out.append((i, len(raw), _digest(raw), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


def _got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.fixture(scope="module")
def pages(spark, small):
    own = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    own += [(None, "u", None)] * 60 + [(None, None, "only without ids")] * 2 + [(7000, "q", f"t{i}") for i in range(80)]
    own += [(1000 + i, "http://x/\r\nX: 1 é" if i % 3 else None, ["same", "", "é\r\n\r\nß WARC/1.1"][i % 3]) for i in range(30)]
    return own + [(2000, "a", "dup"), (2000, "a", "dup"), (2000, "b", "dup"), (1, "z", "dup"), (7000, "q", "in a hot id"), (6000, "q", "in a hot id")]


def _table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, key string, shard int").repartition(5)


@pytest.mark.parametrize("least", [0, 4])
def test_round_trip_and_the_same_bytes_again(spark, pages, monkeypatch, least):
    monkeypatch.setattr(warc, "HOT_ROWS", 50)
    monkeypatch.setattr(warc, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(warc, "SPLIT_BYTES", 3_000)
    digests = []
    for turn in range(2):
        path = table_path(spark, "warc")
        warc.write_archives(_table(spark, pages if turn else pages[::-1]), path, least_bytes=least, file_bytes=8_000)
        files = sorted(glob.glob(path.removeprefix("file://") + "/*"))
        digests.append({f.rsplit("/", 1)[1]: hashlib.sha256(open(f, "rb").read()).hexdigest() for f in files if f.endswith(".gz") and "-0000000-0000" not in f})
        read = warc.read_archives(spark, path)
        assert _got(read) == _want(pages, least)
        rows = read.collect()
        assert len({r["record_id"] for r in rows}) == len(rows)
        assert all((r["payload"] is None) == (r["record_type"] == "revisit") for r in rows)
        assert all(r["payload"] is None or _digest(bytes(r["payload"])) == r["payload_digest"] for r in rows)
        manifest = [json.loads(line) for line in open(path.removeprefix("file://") + "/manifest.jsonl")]
        assert len(files) == len(manifest) + 1 and len(manifest) > 5 and sum(f["records"] for f in manifest) == len(pages)
        for f in manifest:
            raw = open(path.removeprefix("file://") + "/" + f["file"], "rb").read()
            assert len(raw) == f["bytes"] and hashlib.sha256(raw).hexdigest() == f["sha256"] and gzip.decompress(raw).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        # a file is closed by the record that brings it to its size
        sizes = {f["file"]: f["bytes"] for f in manifest}
        assert all(size >= 8_000 for name, size in sizes.items() if any(name[:-14] == other[:-14] and other > name for other in sizes))
    assert digests[0] == digests[1] and digests[0]


def test_repeated_payloads_that_are_not_broadcast(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(warc, "HOT_ROWS", 20)
    path = table_path(spark, "warc")
    warc.write_archives(_table(spark, pages), path)
    assert _got(warc.read_archives(spark, path, payloads=False)) == _want(pages)


def test_empty_table_and_broken_archives(spark, pages, tmp_path):
    path = str(tmp_path / "none")
    warc.write_archives(_table(spark, pages).limit(0), path)
    assert warc.read_archives(spark, path).count() == 0
    raw = gzip.compress(b"WARC/1.1\r\nWARC-Record-ID: <a>\r\nContent-Length: 2\r\n\r\nab\r\n\r\n")
    assert [block for _, block in warc.records(iter([raw[:9], raw[9:]]))] == [b"ab"]
    with pytest.raises(ValueError, match="within a record"):
        list(warc.records(iter([raw[:-12]])))
    row = {"page_id": 1, "url": None, "payload": b"text", "key": b"k", "piece": 0, "revisit": False, "refers_to": None, "refers_named": False, "refers_url": None}
    (fields, block), = warc.records(iter([gzip.compress(warc.page_record(row, "2000-01-01T00:00:00Z"))]))
    assert warc._page(fields, block, True)[4:8] == (4, _digest(b"text"), None, b"text")
    with pytest.raises(ValueError, match="digest"):
        warc._page(fields, block.replace(b"text", b"tex_"), True)


def test_an_attempt_that_fails_leaves_nothing(spark, pages, tmp_path):
    path = str(tmp_path / "failed")
    writer = warc._Writer({"path": path, "date": "2000-01-01T00:00:00Z", "filebytes": "1000"})
    import pyarrow as pa

    row = {"shard": 0, "piece": 0, "page_id": 1, "url": "u", "payload": b"x" * 50, "key": b"k", "revisit": False, "refers_to": None, "refers_url": None, "refers_named": False}
    batch = lambda **more: pa.RecordBatch.from_pylist([row | {"refers_to": 0, "refers_url": ""} | more])
    writer.write(iter([batch()]))  # its executor is lost: its message never comes
    done = writer.write(iter([batch()]))
    writer.commit([done, None])
    assert sorted(p.name for p in (tmp_path / "failed").iterdir()) == ["manifest.jsonl", "pages-0000000-00000-00000.warc.gz"]
    assert warc.read_archives(spark, path).count() == 1


def test_query_against_the_rows(spark, small):
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    assert _got(queries.queries()["op13_warc"](spark, small)) == _want(rows)

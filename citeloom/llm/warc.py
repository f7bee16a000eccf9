"""WARC archives of pages: a deterministic sharded writer, and a reader of its archives.

Pages are dealt to ranges of page_id whose bounds follow from the ids and sizes alone, sorted, and written as one gzip member
for each record; a file that reaches its compressed size is followed by the next.  A task writes under names of its attempt;
the driver's commit renames the files of the tasks that count and then publishes a manifest with sizes, digests and places
to start reading, so a lost executor leaves nothing behind and a reader sees all files or none.  Payloads that are equal to
that of a larger page_id become revisits of it.
"""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from citeloom.llm.common import materialize

#: Bytes of payload of a shard, the least shards that a corpus of at least a MB each is dealt to, and ids sampled for the bounds.
SHARD_BYTES, LEAST_SHARDS, SAMPLED = 256 << 20, 48, 1_000_000
#: Rows under one id above which they are dealt to several shards, and the share of all rows; so there are a thousand such ids.
HOT_ROWS, HOT_SHARE = 5_000, 1_000
#: Bytes of a table of repeated payloads that is broadcast, at about so many a row.
BROADCAST_BYTES, ROW_BYTES = 64 << 20, 200
#: Compressed bytes after which a reader may start another task.
SPLIT_BYTES = 4 << 20
#: What the format calls a record that repeats an earlier payload, and its version.
PROFILE, VERSION = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC/1.1"
RECORDS = "page_id long, url string, record_type string, record_id string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def base32_sha1(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_id(page_id: int | None, key: bytes, piece: int = 0, copy: int = 0) -> str:
    """The same id for the same page, payload and place among its copies, whenever it is written."""
    name = f"{page_id}|{key.hex()}" + (f"|{piece}|{copy}" if piece or copy else "")
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, name)}>"


def _header_value(text: str) -> str:
    """A value without control characters and blanks, which are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in [*fields, ("Content-Length", str(len(block)))] if value is not None]
    return "\r\n".join([VERSION, *lines, "", ""]).encode() + block + b"\r\n\r\n"


def page_record(row: dict, date: str, copy: int = 0) -> bytes:
    """A response with the payload, or a revisit with the HTTP headers alone; digests are taken anew."""
    payload, digest = row["payload"], base32_sha1(row["payload"])
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if row["revisit"] else http + payload
    same = row["revisit"] and row["refers_named"]
    fields = [
        ("WARC-Type", "revisit" if row["revisit"] else "response"), ("WARC-Record-ID", record_id(row["page_id"], row["key"], row["piece"], copy)), ("WARC-Date", date),
        ("WARC-Target-URI", None if row["url"] is None else _header_value(row["url"])), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("X-Page-ID", None if row["page_id"] is None else str(row["page_id"])),
        ("WARC-Profile", PROFILE if row["revisit"] else None), ("WARC-Refers-To", record_id(row["refers_to"], row["key"]) if same else None),
        ("WARC-Refers-To-Target-URI", _header_value(row["refers_url"]) if row["revisit"] and row["refers_url"] is not None else None),
        ("WARC-Refers-To-Date", date if row["revisit"] else None), ("X-Refers-To-Page-ID", str(row["refers_to"]) if row["revisit"] else None)]
    return _record(fields, block)


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """A file system and a path in it, from a URI or a plain path."""
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    #: For each file its name, the name that its task gave it, records, bytes, SHA-256 and the places to start reading.
    files: list[dict]


class _Roll:
    """The files of a shard, one after another: each ends with the record that brings it to its size."""

    def __init__(self, system: fs.FileSystem, folder: str, shard: tuple[int, int], date: str, file_bytes: int):
        self.system, self.folder, self.shard, self.date, self.file_bytes = system, folder, shard, date, file_bytes
        self.files: list[dict] = []
        self.out = None

    def _open(self) -> None:
        name = f"pages-{self.shard[0]:07d}-{self.shard[1]:05d}-{len(self.files):05d}.warc.gz"
        self.files.append({"file": name, "temporary": posixpath.join(self.folder, f"{name}.open"), "records": 0, "bytes": 0, "splits": []})
        self.out, self.digest = self.system.open_output_stream(self.files[-1]["temporary"], compression=None), hashlib.sha256()
        info = f"software: citeloom\r\nformat: {VERSION}\r\n".encode()
        self._put(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, name)}>"), ("WARC-Date", self.date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], info))

    def _put(self, record: bytes) -> None:
        own = self.files[-1]
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # a member for each record, with neither name nor time
        member = packer.compress(record) + packer.flush()
        if not own["splits"] or own["bytes"] - own["splits"][-1] >= SPLIT_BYTES:
            own["splits"].append(own["bytes"])
        self.out.write(member)
        self.digest.update(member)
        own["bytes"] += len(member)

    def put(self, record: bytes) -> None:
        if self.out is None:
            self._open()
        self._put(record)
        self.files[-1]["records"] += 1
        if self.files[-1]["bytes"] >= self.file_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.files[-1]["sha256"] = self.digest.hexdigest()
            self.out = None


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.date, self.file_bytes = options["path"], options["date"], int(options["filebytes"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = open_folder(self.path)
        folder = posixpath.join(root, "_temporary", uuid.uuid4().hex)
        files: list[dict] = []
        roll, last, copy = None, None, 0
        for batch in iterator:
            if roll is None and batch.num_rows:
                system.create_dir(folder, recursive=True)
            for k in range(batch.num_rows):
                row = {name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names)}
                shard, name = (row["shard"], row["piece"]), (row["shard"], row["piece"], row["page_id"], row["key"])
                if roll is None or roll.shard != shard:
                    if roll is not None:
                        roll.close()
                        files += roll.files
                    roll = _Roll(system, folder, shard, self.date, self.file_bytes)
                copy = copy + 1 if name == last else 0
                last = name
                roll.put(page_record(row, self.date, copy))
        if roll is not None:
            roll.close()
            files += roll.files
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = open_folder(self.path)
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: f["file"])
        for f in files:
            system.move(f.pop("temporary"), posixpath.join(root, f["file"]))
        open_name = posixpath.join(root, f"_manifest-{uuid.uuid4().hex}.open")
        system.create_dir(root, recursive=True)
        with system.open_output_stream(open_name, compression=None) as out:
            for f in files:
                out.write((json.dumps(f, sort_keys=True) + "\n").encode())
        system.move(open_name, posixpath.join(root, "manifest.jsonl"))
        self._clean(system, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clean(*open_folder(self.path))

    @staticmethod
    def _clean(system: fs.FileSystem, root: str) -> None:
        folder = posixpath.join(root, "_temporary")
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)


class WarcArchives(DataSource):
    """format("warc-archives"): the sink of write_archives, which prepares its rows."""

    @classmethod
    def name(cls) -> str:
        return "warc-archives"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options)


def shard_bounds(counts: DataFrame, rows: int, size: int) -> np.ndarray:
    """Ids that begin a shard each, from counts(page_id, n, size): weighted quantiles of ids chosen by their hash."""
    shards = max(-(-size // SHARD_BYTES), min(LEAST_SHARDS, -(-size // (1 << 20))), 1)
    every = max(1, -(-rows // min(50 * shards, SAMPLED)))
    chosen = counts.where(f"page_id is not null and pmod(xxhash64(page_id), {every}) = 0").groupBy("page_id").agg(F.sum(F.col("n") * (F.col("size") + 500)).alias("w"))
    held = chosen.orderBy("page_id").toArrow()  # SAMPLED ids, give or take the spread of their hashes
    ids, weight = held.column("page_id").to_numpy(), held.column("w").to_numpy().astype(float)
    if not len(ids):
        return np.zeros(0, np.int64)
    at = np.searchsorted(np.cumsum(weight), weight.sum() * np.arange(1, shards) / shards)
    return np.unique(ids[np.minimum(at, len(ids) - 1)]).astype(np.int64)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, file_bytes: int = 1 << 30, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write a record for each row of pages(page_id, url, html) in a new folder at path, with manifest.jsonl.

    The payload is the html in UTF-8, a null one empty.  Of payloads of at least least_bytes that are equal, the one with the
    largest page_id is a response and the others are revisits of it; smaller payloads are all responses, and so are rows that
    repeat the id of the response, and equal payloads that all lack an id.  A null url is left out; blanks and control
    characters in one are percent-encoded.  The same rows give the same files, byte for byte, in any order; but rows that
    repeat id and payload many times are dealt to several shards by their place in the scan.  An empty table gives an empty manifest.  Further columns are
    not read.
    """
    spark = pages.sparkSession
    spark.dataSource.register(WarcArchives)
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("key", F.unhex(F.sha2("payload", 256)))
    counts = rows.groupBy("page_id", "key").agg(F.count("*").alias("n"), F.max(F.octet_length("payload")).cast("long").alias("size"), F.max("url").alias("url"))
    counts = materialize(counts, "warc-keys")
    total, size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") * F.col("size")), F.lit(0))).first()
    most = max(HOT_ROWS, total // HOT_SHARE)
    bounds = spark.sparkContext.broadcast(shard_bounds(counts, total, size))

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        return pd.Series(np.where(known, np.searchsorted(bounds.value, ids.fillna(0).to_numpy(np.int64), "right"), 0).astype(np.int32))

    hot = counts.groupBy(F.col("page_id").alias("_id")).agg(F.sum("n").alias("_n")).where(F.col("_n") >= most)
    hot = materialize(hot.select("_id", F.ceil(F.col("_n") / most).cast("int").alias("_pieces")), "warc-hot")  # a thousand rows at most
    first = F.max(F.struct("page_id", "url"))
    again = counts.where(F.col("size") >= least_bytes).groupBy("key").agg(F.sum("n").alias("_copies"), first.alias("_first")).where("_copies > 1 and _first.page_id is not null")
    named = again.join(F.broadcast(hot), F.col("_first.page_id") == F.col("_id"), "left").select("key", "_copies", "_first", F.col("_id").isNull().alias("refers_named"))
    named = materialize(named, "warc-repeated")
    if named.count() * ROW_BYTES <= BROADCAST_BYTES:
        rows = rows.join(F.broadcast(named), "key", "left")
    else:  # payloads with very many copies stay where they are, others meet by their digest
        often = F.broadcast(named.where(F.col("_copies") >= most))
        rows = rows.join(often.select("key"), "key", "left_anti").join(named, "key", "left").unionByName(rows.join(often, "key"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first.page_id")), F.col("_first.page_id"))
    rows = rows.withColumn("refers_to", refers).withColumns({"revisit": F.col("refers_to").isNotNull(), "refers_url": F.col("_first.url")})
    rows = rows.join(F.broadcast(hot), F.col("page_id").eqNullSafe(F.col("_id")), "left")
    same = F.broadcast(counts.where(F.col("n") >= most).select(F.col("page_id").alias("_same_id"), F.col("key").alias("_same_key")))  # a thousand rows at most
    rows = rows.join(same, F.col("page_id").eqNullSafe(F.col("_same_id")) & (F.col("key") == F.col("_same_key")), "left")
    place = F.when(F.col("_same_key").isNotNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64("key", "url"))
    piece = F.coalesce(F.pmod(place, F.col("_pieces")).cast("int"), F.lit(0))
    rows = rows.select(shard_of("page_id").alias("shard"), piece.alias("piece"), "page_id", "url", "payload", "key", "revisit", "refers_to", "refers_url", F.coalesce("refers_named", F.lit(False)).alias("refers_named"))
    dealt = rows.repartition(len(bounds.value) + 1, "shard", "piece").sortWithinPartitions("shard", "piece", "page_id", "key", "url")
    dealt.write.format("warc-archives").mode("append").option("date", date).option("filebytes", file_bytes).save(path)


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if line)


def records(raw: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each gzip member of a stream of bytes."""
    packer, parts = zlib.decompressobj(31), []
    for chunk in raw:
        while chunk:
            parts.append(packer.decompress(chunk))
            chunk = packer.unused_data
            if packer.eof:
                head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
                fields = _fields(head)
                block = rest[: int(fields["Content-Length"])]
                if rest[len(block) :] != b"\r\n\r\n":
                    raise ValueError(f"{fields.get('WARC-Record-ID')}: the record does not end where its header says")
                yield fields, block
                packer, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends within a record")


def _page(fields: dict[str, str], block: bytes, payloads: bool) -> tuple:
    """A row of RECORDS, with the digests of what was read held against those of the header."""
    number = lambda name: int(fields[name]) if name in fields else None
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size, response = int(_fields(head)["Content-Length"]), fields["WARC-Type"] == "response"
    if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}" or response and (base32_sha1(payload) != digest or len(payload) != size):
        raise ValueError(f"{fields['WARC-Record-ID']}: the digest is not that of the record")
    return number("X-Page-ID"), fields.get("WARC-Target-URI"), fields["WARC-Type"], fields["WARC-Record-ID"], size, digest, number("X-Refers-To-Page-ID"), payload if response and payloads else None


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The pages of the archives that a manifest names, a row for each record; digests are verified on the way.

    page_id, url, record_type, record_id, payload_bytes and payload_digest of the full payload, refers_to (the response's
    page_id, for revisits) and payload (null for revisits, and for all without `payloads`).
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(path)
        names = [f.split()[0] for f in RECORDS.split(", ")]
        schema = pa.schema([(n, pa.binary() if n == "payload" else pa.int64() if t == "long" else pa.string()) for n, t in (f.split() for f in RECORDS.split(", "))])
        for batch in batches:
            for file, start, end in zip(*(batch.column(k).to_pylist() for k in range(3))):
                held, size = [], 0
                with system.open_input_file(posixpath.join(root, file)) as source:
                    for fields, block in records(_chunks(source, start, end)):
                        if fields["WARC-Type"] != "warcinfo":
                            held.append(_page(fields, block, payloads))
                            size += len(block)
                            if size > SPLIT_BYTES:
                                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], names)
                                held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], names)

    files = spark.read.schema("file string, bytes long, records long, splits array<long>").json(posixpath.join(path, "manifest.jsonl"))
    ends = F.concat(F.slice("splits", 2, F.size("splits")), F.array("bytes"))
    splits = files.select("file", F.explode(F.arrays_zip(F.col("splits").alias("start"), ends.alias("end"))).alias("s")).select("file", "s.start", "s.end")
    n = files.agg(F.coalesce(F.sum(F.size("splits")), F.lit(0))).first()[0]
    return splits.repartition(max(1, min(n, 100_000)), "file", "start").mapInArrow(over, RECORDS)


def _chunks(source, start: int, end: int, size: int = 1 << 16) -> Iterator[bytes]:
    source.seek(start)
    while start < end:
        chunk = source.read(min(size, end - start))
        if not chunk:
            raise ValueError("the archive is shorter than its manifest says")
        start += len(chunk)
        yield chunk

"""Literature services as Python data sources: cursor pages, chunks of keys and numbered pages, with retries.

The transport is any function (url, params) -> (status, headers, body), so tests need no network.
"""

from __future__ import annotations

import functools
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import StreamingQueryException
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from citeloom.plans.written import numbered

Transport = Callable[[str, dict], tuple[int, dict, str]]
#: Answers after which a request is sent again.
RETRYABLE = {408, 429, 502, 503, 529}


class RequestFailed(RuntimeError):
    pass


def http_get(url: str, params: dict, headers: dict | None = None) -> tuple[int, dict, str]:
    try:
        with urllib.request.urlopen(urllib.request.Request(f"{url}?{urllib.parse.urlencode(params)}", headers=headers or {}), timeout=60) as answer:
            return answer.status, dict(answer.headers), answer.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers), e.read().decode(errors="replace")


def retryable(status: int | None) -> bool:
    """Whether to ask again: known passing states, server errors and unknown states."""
    return status is None or status in RETRYABLE or status >= 500


def request(transport: Transport, url: str, params: dict, attempts: int = 5, wait: float = 1.0, exponential: bool = True, sleep=time.sleep) -> str:
    """The body of a good answer; a bad request fails at once, a busy server is asked again after the time it names."""
    status: int | None = None
    for attempt in range(1, attempts + 1):
        headers: dict = {}
        try:
            status, headers, body = transport(url, params)
            if 200 <= status < 300:
                return body
        except OSError:
            status = None
        if not retryable(status):
            raise RequestFailed(f"{url}: status {status}")
        if attempt < attempts:
            named = str(headers.get("Retry-After", ""))
            sleep(float(named) if named.isdigit() else wait * (2 ** (attempt - 1) if exponential else attempt))
    raise RequestFailed(f"{url}: no answer after {attempts} attempts, last status {status}")


def cursor_pages(transport: Transport, url: str, params: dict, **retry) -> Iterator[str]:
    """Pages by cursor; ends with an empty page or a cursor that is missing or repeats."""
    cursor = "*"
    while True:
        body = request(transport, url, params | {"cursorMark": cursor}, **retry)
        page = json.loads(body)
        if not page.get("response", {}).get("docs"):
            return
        yield body
        following = page.get("nextCursorMark")
        if not following or following == cursor:
            return
        cursor = following


class _Part(InputPartition):
    def __init__(self, params: dict):
        super().__init__(json.dumps(params, sort_keys=True))
        self.params = params


def _transport(options: dict) -> Transport:
    if options.get("transport"):
        return load_transport(options["transport"])
    if options.get("token"):
        return functools.partial(http_get, headers={"Authorization": f"Bearer {options['token']}"})
    return http_get


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.url = options["url"]
        self.mode = options.get("mode", "cursor")
        self.params = json.loads(options.get("params", "{}"))
        self.parts = json.loads(options.get("parts", "[{}]"))
        self.attempts = int(options.get("attempts", "5"))
        self.transport = _transport(options)
        self.pause = float(options.get("pause", "0"))

    def partitions(self) -> list[InputPartition]:
        return [_Part(p) for p in (self.parts if self.mode != "cursor" else [{}])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        params = self.params | (partition.params if partition is not None else {})
        name = json.dumps(params, sort_keys=True)
        try:
            if self.mode == "cursor":
                for body in cursor_pages(self.transport, self.url, params, attempts=self.attempts):
                    yield name, body, None
            else:
                time.sleep(self.pause)
                yield name, request(self.transport, self.url, params, attempts=self.attempts), None
        except RequestFailed as e:  # a failed part is a row of its own, so that others are not lost with it
            yield name, None, str(e)


class _Scan(SimpleDataSourceStreamReader):
    """A scan by cursor whose offset is the cursor of the next page; a page that fails ends the batch, and the offset stays.

    Pages follow from each other, so they are asked one by one, and the pause between two requests holds for the whole scan.
    """

    def __init__(self, options: dict):
        self.url, self.params, self.attempts = options["url"], json.loads(options.get("params", "{}")), int(options.get("attempts", "5"))
        self.transport, self.pause, self.pages = _transport(options), float(options.get("pause", "0")), int(options.get("pages", "20"))
        #: Where the cursor goes and comes back, by the service: the parameter, its first value and the key of the answer.
        self.sent, self.first, self.got = options.get("cursorparam", "cursorMark"), options.get("cursorfirst", "*"), options.get("cursorkey", "nextCursorMark")
        self.records = options.get("recordspath", "response.docs").split(".")

    def initialOffset(self) -> dict:
        return {"cursor": self.first, "page": 0, "done": False}

    def _page(self, at: dict) -> tuple[list[tuple], dict]:
        time.sleep(self.pause if at["page"] else 0)
        own = {self.sent: at["cursor"]} if at["cursor"].strip() else {}  # a service may take no token for its first page
        body = request(self.transport, self.url, self.params | own, attempts=self.attempts)
        page = json.loads(body)
        records, following = page, page.get(self.got)
        for key in self.records:
            records = (records or {}).get(key)
        if not records:
            return [], at | {"done": True}
        return [(f"{at['page']:012d}", body, None)], {"cursor": following, "page": at["page"] + 1, "done": not following or following == at["cursor"]}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, at = [], dict(start)
        for _ in range(self.pages):
            if at["done"]:
                break
            own, at = self._page(at)
            rows += own
        return iter(rows), at

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        at = dict(start)
        while at["page"] < end["page"]:
            rows, at = self._page(at)
            if not rows:
                raise RequestFailed(f"{self.url}: page {at['page']} is there no more")
            yield from rows


def scan(spark: SparkSession, url: str, params: dict, folder: str, **options) -> DataFrame:
    """(part, value, error) of all pages of a scan by cursor, in the order of part; kept in a folder as they come.

    A scan that was killed, or whose page failed, goes on at its cursor when it is called again; a finished one asks no page.
    Further options: transport, token, attempts, pause in seconds between two requests, pages of a batch, and for services
    with page tokens cursorparam, cursorfirst, cursorkey and recordspath.
    """
    source = spark.readStream.format("literature").option("url", url).option("params", json.dumps(params, sort_keys=True))
    for name, value in options.items():
        source = source.option(name, value) if value else source
    query = source.load().writeStream.format("parquet").option("path", f"{folder}/pages").option("checkpointLocation", f"{folder}/scan").start()
    try:
        query.processAllAvailable()
    except StreamingQueryException as e:
        raise RequestFailed(f"the search is not whole: {e}") from e
    finally:
        query.stop()
    return spark.read.schema(LiteratureSource.COLUMNS).parquet(f"{folder}/pages")


class LiteratureSource(DataSource):
    """format("literature"): rows (part, value, error).

    Options: url; mode `cursor` (one chained scan) or `parts` (one task for each of `parts`, a JSON list of parameters,
    such as chunks of keys, page numbers or years); params, attempts, transport, token and, in seconds, pause before a part.
    As a stream it is a scan by cursor that goes on where it ended; see scan.
    """

    COLUMNS = "part string, value string, error string"

    @classmethod
    def name(cls) -> str:
        return "literature"

    def schema(self) -> str:
        return self.COLUMNS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Scan(self.options)


def http_post(url: str, payload: dict, headers: dict | None = None) -> tuple[int, dict, str]:
    """As http_get, with the payload as a JSON body."""
    asked = urllib.request.Request(url, json.dumps(payload).encode(), {"Content-Type": "application/json", **(headers or {})})
    try:
        with urllib.request.urlopen(asked, timeout=120) as answer:
            return answer.status, dict(answer.headers), answer.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers), e.read().decode(errors="replace")


#: Keys of one export request, requests at a time, and the format's name in the answer.
CHUNK_KEYS, WORKERS, ANSWER = 2000, 5, "export"


def load_transport(name: str) -> Transport:
    """A transport by module:function."""
    module, _, function = name.partition(":")
    return getattr(__import__(module, fromlist=[function]), function)


def export_keys(keys: DataFrame, url: str, form: str, transport: str = "", token: str | None = None, chunk: int = CHUNK_KEYS, workers: int = WORKERS, attempts: int = 5, wait: float = 2.0) -> DataFrame:
    """(chunk, n, value, error): what a service exports for each chunk of keys(ord, Bibcode), in the order of keys.

    Chunks are made and sent by executors, at most `workers` at a time.  One that fails is a row with its error and no
    value, so that others are not lost with it.
    """
    rows = numbered(keys.select("ord", "Bibcode"), ["ord", "Bibcode"], "number")
    lists = rows.groupBy(F.floor(F.col("number") / chunk).alias("chunk")).agg(F.transform(F.array_sort(F.collect_list(F.struct("number", "Bibcode"))), lambda x: x["Bibcode"]).alias("keys"))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        send = load_transport(transport) if transport else lambda u, p: http_post(u, p, {"Authorization": f"Bearer {token}"} if token else None)
        for batch in batches:
            for number, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                value = error = None
                try:
                    value = json.loads(request(send, url, {"bibcode": own, "format": form, "sort": "score desc"}, attempts=attempts, wait=wait))[ANSWER]
                except (RequestFailed, ValueError, KeyError) as e:
                    error = f"{type(e).__name__}: {e}"
                columns = [pa.array([number], pa.int64()), pa.array([len(own)], pa.int64()), pa.array([value], pa.string()), pa.array([error], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "n", "value", "error"])

    return lists.repartition(workers, "chunk").mapInArrow(over, "chunk long, n long, value string, error string")

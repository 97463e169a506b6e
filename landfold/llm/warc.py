"""Web archives (WARC 1.0) as tables: written from pages, read back as chunks of records.

Writing: a payload that came before is a revisit of the page with the least id that has
it. Payloads longer than a segment are written as a response and continuation records,
each a row of bounded size. Files are compressed, so that each is read by one task.

Reading: a task streams its files through a parser that holds one chunk, never a whole
record. Its rows are (record, chunk number), each with the digest of the payload so far;
the last row of a record has the digest of all of it, checked against the one written.

Inputs: null html is an empty payload and a null url is left out; characters of a url that would
break a header are percent-encoded; rows with equal payloads and the least id are all
responses, so repeated rows are too; a page without an id has the record id "null", and
revisits whichever page with an id has its payload; an empty table gives no records;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Payloads of fewer bytes are never revisits.
LEAST_REVISITED = 100
#: Bytes of a segment when written, and of a chunk when read.
SEGMENT = 1 << 20
CHUNK = 1 << 16
#: Fixed, as a run must give the same files each time.
DATE = "2024-01-01T00:00:00Z"
_END = "\r\n\r\n"


def _header(*fields: Column) -> Column:
    """Header lines; null fields are left out."""
    return F.concat_ws("\r\n", F.lit("WARC/1.0"), *fields)


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def records(pages: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row ``value`` for each record or segment of ``pages`` (page_id, url, html), in order."""
    rows = pages.select(
        "page_id",
        F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    length = F.octet_length("payload")
    firsts = (
        rows.where(length >= LEAST_REVISITED)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select("digest", "first")
    )
    known = rows.join(firsts, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    count = F.when(revisit, F.lit(1)).otherwise(F.greatest(F.lit(1), F.ceil(length / segment))).cast("int")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        length.cast("string"),
        F.lit(_END),
    )
    parts = F.when(revisit, F.array(F.lit(b""))).otherwise(
        F.transform(
            F.sequence(F.lit(0), count - 1),
            lambda i: F.substring(F.col("payload"), i * segment + 1, F.lit(segment)),
        )
    )
    cut = known.select(
        "page_id",
        "url",
        "digest",
        "first",
        revisit.alias("revisit"),
        count.alias("count"),
        http.alias("http"),
        length.alias("length"),
        F.posexplode(parts).alias("i", "part"),
    )
    leading = F.col("i") == 0
    block = F.concat(F.when(leading, F.col("http")).otherwise(F.lit("")), F.col("part").cast("string"))
    several = F.col("count") > 1
    own = _record_id(F.col("page_id"))
    header = _header(
        _field(
            "WARC-Type",
            F.when(~leading, F.lit("continuation")).when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")),
        ),
        _field(
            "WARC-Record-ID",
            F.when(leading, own).otherwise(
                F.concat(F.regexp_replace(own, ">$", ""), F.lit(":segment:"), (F.col("i") + 1).cast("string"), F.lit(">"))
            ),
        ),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Date", F.lit(DATE)),
        F.when(leading, _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))),
        F.when(leading & F.col("revisit"), _field("WARC-Refers-To", _record_id(F.col("first")))),
        F.when(
            leading & F.col("revisit"),
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
        ),
        F.when(several, _field("WARC-Segment-Number", (F.col("i") + 1).cast("string"))),
        F.when(~leading, _field("WARC-Segment-Origin-ID", own)),
        F.when(
            several & (F.col("i") + 1 == F.col("count")),
            _field("WARC-Segment-Total-Length", (F.octet_length("http") + F.col("length")).cast("string")),
        ),
        F.when(leading, F.lit("Content-Type: application/http; msgtype=response")),
        _field("Content-Length", F.octet_length("block").cast("string")),
    )
    return cut.withColumn("block", block).select(F.concat(header, F.lit(_END), F.col("block")).alias("value"))


def write(pages: DataFrame, folder: str, segment: int = SEGMENT) -> None:
    """Writes ``pages`` as compressed archives in a new folder."""
    records(pages, segment).write.option("lineSep", _END).option("compression", "gzip").text(folder)


_CHUNKS = (
    "record_id string, record_type string, refers_to string, chunk_no int, chunk binary,"
    " payload_bytes bigint, digest string, last boolean"
)


class _Parser:
    """Takes an archive's bytes as they come and gives rows of chunks."""

    def __init__(self, chunk: int, payload: bool):
        self._chunk, self._payload = chunk, payload
        self._held = b""
        self._state = self._head
        self.rows: list[dict[str, Any]] = []
        self._record: dict[str, str] | None = None

    def feed(self, data: bytes) -> None:
        self._held += data
        while self._state():
            pass

    def close(self) -> None:
        if self._held or self._state != self._head or self._record is not None:
            raise ValueError("an archive ends within a record")

    def _head(self) -> bool:
        at = self._held.find(b"\r\n\r\n")
        if at < 0:
            return False
        lines = self._held[:at].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("an archive's record does not start with its version")
        fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        self._held = self._held[at + 4 :]
        self._left = int(fields["content-length"])
        number = int(fields.get("warc-segment-number", "1"))
        if number == 1:
            if self._record is not None:
                raise ValueError("a segmented record has no last segment")
            self._record = fields
            self._http: bytes | None = b""
            self._digest = hashlib.sha256()
            self._pending = bytearray()
            self._number = self._seen = 0
        elif self._record is None or fields.get("warc-segment-origin-id") != self._record["warc-record-id"]:
            raise ValueError("a segment does not follow on its record")
        self._ends = "warc-segment-number" not in fields or "warc-segment-total-length" in fields
        self._state = self._block
        return True

    def _block(self) -> bool:
        take = self._held[: self._left]
        self._held = self._held[len(take) :]
        self._left -= len(take)
        if self._http is not None:
            self._http += take
            at = self._http.find(b"\r\n\r\n")
            take = b""
            if at >= 0:
                take, self._http = self._http[at + 4 :], None
        self._take(take)
        if self._left:
            return False
        if self._ends:
            self._emit(last=True)
            self._record = None
        self._state = self._tail
        return True

    def _tail(self) -> bool:
        if len(self._held) < 4:
            return False
        if self._held[:4] != b"\r\n\r\n":
            raise ValueError("a record is longer than its header says")
        self._held = self._held[4:]
        self._state = self._head
        return True

    def _take(self, data: bytes) -> None:
        for at in range(0, len(data), self._chunk):
            self._pending += data[at : at + self._chunk]
            # The last chunk is kept back, as only the end of the record tells that it is the last.
            while len(self._pending) > self._chunk:
                self._emit(last=False)

    def _emit(self, last: bool) -> None:
        part = bytes(self._pending[: self._chunk])
        del self._pending[: self._chunk]
        self._digest.update(part)
        self._seen += len(part)
        record = self._record
        assert record is not None
        written = record.get("warc-payload-digest", "").removeprefix("sha256:")
        digest = self._digest.hexdigest()
        revisit = record["warc-type"] == "revisit"
        if revisit:
            digest = written
        elif last and written and digest != written:
            raise ValueError(f"the payload of {record['warc-record-id']} is not what was written")
        self.rows.append(
            {
                "record_id": record["warc-record-id"],
                "record_type": record["warc-type"],
                "refers_to": record.get("warc-refers-to"),
                "chunk_no": self._number,
                "chunk": None if revisit or not self._payload else part,
                "payload_bytes": None if revisit else self._seen,
                "digest": digest,
                "last": last,
            }
        )
        self._number += 1


def _parsed(chunk: int, payload: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema(
        [
            ("record_id", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.string()),
            ("chunk_no", pa.int32()),
            ("chunk", pa.binary()),
            ("payload_bytes", pa.int64()),
            ("digest", pa.string()),
            ("last", pa.bool_()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _Parser(chunk, payload)
        for batch in batches:
            for value in batch.column(0):
                parser.feed(value.as_py() + b"\r\n\r\n")
                if len(parser.rows) >= 256:
                    yield pa.RecordBatch.from_pylist(parser.rows, schema=schema)
                    parser.rows = []
        parser.close()
        if parser.rows:
            yield pa.RecordBatch.from_pylist(parser.rows, schema=schema)

    return run


def read_chunks(spark: SparkSession, folder: str, chunk: int = CHUNK, payload: bool = True) -> DataFrame:
    """Chunks of all records of the archives in ``folder``.

    ``payload_bytes`` and ``digest`` are of the payload up to and with this chunk; of a
    revisit, which has no payload, they are null and the digest that it names.
    """
    lines = spark.read.option("lineSep", _END).schema("value string").text(folder)
    return lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(_parsed(chunk, payload), _CHUNKS)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each record: its id, type, what it refers to, and its full payload's size and digest."""
    ends = read_chunks(spark, folder, payload=False).where("last").drop("chunk", "chunk_no", "last")
    responses = (
        ends.where("record_type = 'response'")
        .select(F.col("record_id").alias("refers_to"), "digest", F.col("payload_bytes").alias("referred"))
        .distinct()
    )
    return ends.join(responses, ["refers_to", "digest"], "left").select(
        "record_id",
        "record_type",
        "refers_to",
        F.coalesce("payload_bytes", "referred").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
    )


def page_of(record_id: Column) -> Column:
    """The page id in a record id, as text; null for a page without one."""
    return F.nullif(F.regexp_extract(record_id, "^<urn:page:(.*)>$", 1), F.lit("null"))

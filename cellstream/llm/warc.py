"""WARC archives by way of a chunked record table.

A payload is a number of rows, each of a record's identifier, a chunk number and at most `size` bytes,
that stand together and in order within a partition. Everything that meets payloads outside of the
given table goes by such rows: digests are carried from chunk to chunk, archives are written chunk by
chunk and read back so. In the archive, too, a payload stands in chunks: the HTTP message of a
response has the chunked transfer coding, so each of its chunks begins and ends at a line's end, and
Spark's text writer and reader, with CRLF as line separator, pass them one by one, on any file
system, under Spark's commit protocol. An archive is a gzip file, which one task writes and one reads.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, parts_of, salt, spread_join, stored

SIZE = 1 << 16
EOL = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = EOL.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=UTF-8"])
CHUNKED = "Transfer-Encoding: chunked"


def chunks(payload: Column, size: int = SIZE) -> Column:
    """The parts of a payload, of so many bytes but for the last; an empty payload has none."""
    n = F.ceil(F.octet_length(payload) / size).cast("int")
    return F.transform(F.slice(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), F.lit(1), n), lambda i: F.substring(payload, i * size + 1, F.lit(size)))


def record_table(pages: DataFrame, ids: list[str], payload: str, size: int = SIZE) -> DataFrame:
    """ids, chunk_no, data: a row for each chunk of each row of pages, in order; one row of a null chunk where the payload is empty or null."""
    some = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    return pages.select(*ids, F.posexplode_outer(chunks(some, size)).alias("chunk_no", "data"))


def digested(table: DataFrame, ids: list[str]) -> DataFrame:
    """ids, payload_bytes, payload_digest (base 32 of SHA-1) of a record table, from digests carried over the chunks of a record."""
    kinds = {f.name: f.dataType.simpleString() for f in table.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in ids) + ", payload_bytes bigint, payload_digest string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sha, size = None, None, 0
        for batch in batches:
            done = []
            for row, number, data in zip(zip(*[batch.column(c).to_pylist() for c in ids]), batch.column("chunk_no").to_pylist(), batch.column("data")):
                if not number:  # 0, or null for the only row of an empty payload
                    if sha:
                        done.append((*own, size, _text(sha)))
                    own, sha, size = row, hashlib.sha1(), 0
                if data.is_valid:
                    sha.update(data.as_buffer())
                    size += len(data.as_buffer())
            if done:
                yield _batch(done, batch, ids)
        if sha:
            yield _batch([(*own, size, _text(sha))], batch, ids)

    return table.select(*ids, "chunk_no", "data").mapInArrow(run, schema)


def _text(sha: object) -> str:
    return base64.b32encode(sha.digest()).decode()


def _batch(rows: list[tuple], like: pa.RecordBatch, ids: list[str]) -> pa.RecordBatch:
    kinds = [like.schema.field(c).type for c in ids] + [pa.int64(), pa.string()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [*ids, "payload_bytes", "payload_digest"])


def record_types(digests: DataFrame, least: int = 0) -> DataFrame:
    """digests with refers_to: for payloads of `least` bytes or more, the smallest page_id of an equal payload where that is another one, else null.

    Payloads are equal if bytes and digest are. A row without page_id refers to nothing. The rows of a frequent payload are spread.
    """
    key = ["payload_digest", "payload_bytes"]
    first = digests.groupBy(*key).agg(F.min("page_id").alias("__first"), parts_of(salt("page_id")).alias("parts"))
    refers = F.when((F.col("payload_bytes") >= least) & (F.col("__first") < F.col("page_id")), F.col("__first"))
    return spread_join(digests, first, key, "page_id").withColumn("refers_to", refers).drop("__first")


def _named(id_: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(id_.cast("string")), F.lit("")), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def lines(date: str, size: int = SIZE) -> Column:
    """The lines of a record, as binary values, from columns page_id, url, __payload (binary), payload_bytes, payload_digest, refers_to."""
    length = F.col("payload_bytes")
    whole, rest = F.floor(length / size), length % size
    hex_of = lambda n: F.lower(F.hex(n))
    framed = whole * (size + len(f"{size:x}") + 4) + F.when(rest > 0, rest + F.length(hex_of(rest)) + 4).otherwise(0) + 5
    revisit = F.col("refers_to").isNotNull()
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = F.concat_ws(
        EOL, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")), _field("WARC-Record-ID", _named(F.col("page_id"))), F.lit(f"WARC-Date: {date}"),
        _field("WARC-Target-URI", url), F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")), F.when(revisit, _field("WARC-Refers-To", _named(F.col("refers_to")))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")), F.lit("Content-Type: application/http; msgtype=response"),
        _field("Content-Length", F.when(revisit, len(HTTP) + 2 * len(EOL)).otherwise(framed + len(HTTP) + len(CHUNKED) + 3 * len(EOL)).cast("bigint").cast("string")), F.lit(""), F.lit(HTTP),
    )
    data = F.transform(chunks(F.col("__payload"), size), lambda c: F.concat(F.concat(hex_of(F.octet_length(c)), F.lit(EOL)).cast("binary"), c))
    response = F.concat(F.array(F.concat(head, F.lit(EOL + CHUNKED + EOL)).cast("binary")), data, F.array(F.lit(("0" + EOL * 3).encode())))
    return F.when(revisit, F.array(F.concat(head, F.lit(EOL * 3)).cast("binary"))).otherwise(response)


def write(pages: DataFrame, path: str, payload: str = "html", least: int = 0, date: str = "2000-01-01T00:00:00Z", size: int = SIZE) -> None:
    """Writes page_id, url and payload of every row as a WARC record, into gzip files under path.

    Of rows with equal payloads of `least` bytes or more, that of the smallest page_id is a response and the others revisit it; smaller
    ones are all responses. Null payloads are empty, a null url gives no WARC-Target-URI, line ends in a url are escaped. Repeated
    rows of the smallest page_id are a response each; rows without page_id are responses. Only small rows and, once, the pages
    themselves are shuffled; an empty table gives no record.
    """
    plain = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("__payload"))
    plain = plain.withColumn("__check", F.xxhash64("__payload"))  # tells rows of one page_id apart
    ids = ["page_id", "__check"]
    digests = stored(digested(record_table(plain, ids, "__payload", size), ids).distinct(), "digests")
    kinds = stored(record_types(digests, least).withColumnsRenamed({"page_id": "__id", "__check": "__its"}), "record-types")
    same = F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("__check") == F.col("__its"))
    record = plain.join(kinds.hint("shuffle_hash"), same).select(F.explode(lines(date, size)).alias("value"))
    record.select(F.col("value").cast("string")).write.option("lineSep", EOL).option("compression", "gzip").text(path)
    discard(digests, kinds)


class Parser:
    """Reads the lines of archives, in order; calls back with the header fields of each record, then with each part of its payload, then with None."""

    def __init__(self, begun: Callable[[dict[str, str]], None], data: Callable[[bytes], None], ended: Callable[[], None]):
        self.begun, self.data, self.ended = begun, data, ended
        self.expects, self.fields, self.chunked = self._start, {}, False
        self.parts, self.got, self.size = [], 0, 0

    def feed(self, line: bytes) -> None:
        self.expects(line)

    def _start(self, line: bytes) -> None:
        if line.startswith(b"WARC/"):
            self.fields, self.expects = {}, self._header
        elif line:
            raise ValueError(f"no WARC record begins here: {line[:80]!r}")

    def _header(self, line: bytes) -> None:
        if line:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            self.fields[name.lower()] = value.strip()
            return
        self.left, self.chunked = int(self.fields["content-length"]), False
        self.begun(self.fields)
        if self.fields.get("content-type", "").startswith("application/http"):
            self.expects = self._http
        else:
            self._body()

    def _http(self, line: bytes) -> None:
        self.left -= len(line) + 2
        if line.lower().replace(b" ", b"") == b"transfer-encoding:chunked":
            self.chunked = True
        if not line:
            self._body()

    def _body(self) -> None:
        if self.chunked:
            self.expects = self._chunk
        elif self.left > 0:
            self._expect(self.left)
        else:
            self._end()

    def _end(self) -> None:
        self.expects = self._start
        self.ended()

    def _expect(self, size: int) -> None:
        self.got, self.size, self.expects = 0, size, self._payload

    def _chunk(self, line: bytes) -> None:
        size = int(line.split(b";")[0], 16)
        if size:
            self._expect(size)
        else:
            self.expects = lambda trailer: None if trailer else self._end()

    def _payload(self, line: bytes) -> None:
        self.got += len(line)
        if self.got > self.size:
            raise ValueError("a payload is longer than its record says")
        self.data(line)
        if self.got < self.size:  # the line's end is part of the payload
            self.data(EOL.encode())
            self.got += len(EOL)
        elif self.chunked:
            self.expects = self._chunk
        else:
            self._end()


def _lines_of(batches: Iterator[pa.RecordBatch], parser: Parser, out: list, most: int) -> Iterator[list]:
    """Feeds the parser; gives what it has put out, whenever that is `most` or more bytes or rows, and at the end."""
    for batch in batches:
        for line in batch.column("value").to_pylist():
            parser.feed(line)
            if len(out) >= most:
                yield out
                out.clear()
    if parser.expects != parser._start:
        raise ValueError("an archive ends within a record")
    if out:
        yield out
        out.clear()


def _archive_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", EOL).text(path).select(F.col("value").cast("binary").alias("value"))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The record table of archives: record_id, record_type, uri, refers_to, chunk_no, data; records without payload have one row of a null chunk. Records of whatever order, chunks in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, parts = [], {}, []

        def begun(fields: dict[str, str]) -> None:
            now.update(head=(fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-target-uri"), fields.get("warc-refers-to")), number=0, size=0)

        def put() -> None:
            out.append((*now["head"], now["number"], b"".join(parts)))
            now.update(number=now["number"] + 1, size=0)
            parts.clear()

        def data(part: bytes) -> None:
            parts.append(part)
            now["size"] += len(part)
            if now["size"] >= SIZE:
                put()

        def ended() -> None:
            if parts:
                put()
            elif not now["number"]:
                out.append((*now["head"], None, None))

        for rows in _lines_of(batches, Parser(begun, data, ended), out, 256):
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    names, kinds = ["record_id", "record_type", "uri", "refers_to", "chunk_no", "data"], [pa.string()] * 4 + [pa.int32(), pa.binary()]
    return _archive_lines(spark, path).mapInArrow(run, "record_id string, record_type string, uri string, refers_to string, chunk_no int, data binary")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row a record of archives: record_id, record_type, uri, refers_to, stated_digest, payload_bytes, payload_digest, both of the payload as it was read, chunk by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now = [], {}

        def begun(fields: dict[str, str]) -> None:
            head = [fields.get(x) for x in ("warc-record-id", "warc-type", "warc-target-uri", "warc-refers-to")]
            now.update(head=(*head, fields.get("warc-payload-digest", "").removeprefix("sha1:") or None), size=0, sha=hashlib.sha1())

        def data(part: bytes) -> None:
            now["sha"].update(part)
            now["size"] += len(part)

        for rows in _lines_of(batches, Parser(begun, data, lambda: out.append((*now["head"], now["size"], _text(now["sha"])))), out, 4096):
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    names, kinds = ["record_id", "record_type", "uri", "refers_to", "stated_digest", "payload_bytes", "payload_digest"], [pa.string()] * 5 + [pa.int64(), pa.string()]
    return _archive_lines(spark, path).mapInArrow(run, "record_id string, record_type string, uri string, refers_to string, stated_digest string, payload_bytes bigint, payload_digest string")


def resolved(records: DataFrame) -> DataFrame:
    """Records with the payload_bytes and payload_digest of what they revisit, and whether the digest is the stated one (matches; null where the response isn't there or none is stated). The revisits of a frequent payload are spread.

    records is read three times: give a stored table.
    """
    plain = records.where("refers_to is null").withColumn("matches", F.col("payload_digest") == F.col("stated_digest"))
    revisits = records.where("refers_to is not null").drop("payload_bytes", "payload_digest")
    wanted = revisits.groupBy("refers_to").agg(parts_of(salt("record_id")).alias("parts"))
    # Of repeated records one stands for all, as their payloads are equal.
    responses = records.where("refers_to is null").groupBy("record_id").agg(F.min(F.struct("payload_bytes", "payload_digest")).alias("__of"))
    found = wanted.join(responses.withColumnRenamed("record_id", "refers_to"), "refers_to", "left").select("refers_to", "parts", "__of.*")
    back = spread_join(revisits, found, ["refers_to"], "record_id").withColumn("matches", F.col("payload_digest") == F.col("stated_digest"))
    return plain.unionByName(back)


def page_of(urn: str, kind: str = "bigint") -> Column:
    """page_id of a record's identifier."""
    id_ = F.url_decode(F.regexp_extract(urn, "^<urn:page:(.*)>$", 1))
    return F.when(id_ != "", id_).cast(kind)

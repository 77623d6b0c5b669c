"""WARC archives: written as Spark text files, read by a Python data source.

``write`` puts one record per row: of equal payloads the row with the largest id
is the response, the others are revisits that name it and carry no payload.
``WarcSource`` (format ``warc``) plans partitions of whole files, takes over
predicates on the record type and on single-valued headers, parses a record's
headers first and seeks past the block of a record that isn't wanted; option
``payload=false`` skips every block.  Files are reached through pyarrow's file
systems, so local, HDFS, S3 and GCS locations work where pyarrow can open them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith,
)

from ..session import shared_folder
from .base import stored

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
#: Column -> header, of those that filters can reach.
HEADERS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", headers map<string,string>, content_length bigint, payload binary, payload_bytes bigint"
#: Files are packed into partitions of about this size.
SPLIT_BYTES = 64 << 20
CHUNK = 1 << 20
BATCH_BYTES = 8 << 20


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 20 bits, that is five hex digits, make four letters."""
    digest = F.sha1(payload)
    fifths = [F.lpad(F.conv(F.substring(digest, 5 * n + 1, 5), 16, 32), 4, "0") for n in range(8)]
    return F.translate(F.concat(*fifths), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, payload) -> with payload_bytes, payload_digest, record_type, refers_to.

    A null payload is empty.  Null ids count as smallest; rows that tie at the
    largest id of a payload are all responses.  The repeated payloads are found
    from digests alone and stored, so that Spark knows their size when it plans
    the join: payloads move only if there are many.
    """
    full = pages.withColumn("payload", F.coalesce(F.col("payload").cast("binary"), F.lit("").cast("binary")))
    full = full.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload"))})
    groups = full.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(F.max("page_id").alias("_first"), F.count("*").alias("_n"))
    repeated = stored(groups.filter("_n > 1").select(F.col("payload_digest").alias("_digest"), "_first"), "warc-repeated")
    joined = full.join(repeated, F.col("payload_digest") == F.col("_digest"), "left")
    again = F.col("_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.withColumns({
        "record_type": F.when(again, "revisit").otherwise("response"), "refers_to": F.when(again, F.col("_first")),
    }).drop("_digest", "_first")


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0, date: str = DATE) -> None:
    """One record per row below ``folder``, which must not exist yet; other columns are ignored.

    The text sink ends each record with a line feed, the last byte of a record's
    closing two line ends.
    """
    rows = roles(pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{payload}`").alias("payload")), min_bytes)
    end = "\r\n"
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(end)), F.lit(""))
    urn = lambda no: F.concat(F.lit("<urn:page:"), F.coalesce(no.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{end}Content-Type: text/html; charset=utf-8{end}Content-Length: "), F.col("payload_bytes"), F.lit(end + end))
    block_bytes = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    head = F.concat(
        F.lit(f"WARC/1.1{end}"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", urn(F.col("page_id"))), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", urn(F.col("refers_to"))))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", block_bytes.cast("string")), F.lit(end),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    rows.select(F.concat(head, http, body, F.lit("\r\n\r")).alias("value")).write.option("lineSep", "\n").text(folder)


class Files(InputPartition):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``: uncompressed WARC files, one row per record."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.place = options["path"]
        self.with_payload = options.get("payload", "true").lower() == "true"
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))
        #: (header, kind, values)
        self.wanted: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = getattr(f, "attribute", (None,))
            header = HEADERS.get(column[0]) if len(column) == 1 else None
            if header and isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
                self.wanted.append((header, "in", (f.value,)))
            elif header and isinstance(f, In):
                self.wanted.append((header, "in", tuple(f.value)))
            elif header and isinstance(f, StringStartsWith):
                self.wanted.append((header, "prefix", (f.value,)))
            elif header and isinstance(f, IsNotNull):
                self.wanted.append((header, "there", ()))
            else:
                yield f

    def partitions(self) -> list[Files]:
        system, root = fs.FileSystem.from_uri(self.place)
        found = [x for x in system.get_file_info(fs.FileSelector(root, recursive=True)) if x.type == fs.FileType.File and x.size and not x.base_name.startswith(("_", "."))]
        groups, size = [], 0
        for x in sorted(found, key=lambda x: x.path):
            if not groups or size + x.size > self.split_bytes:
                groups.append([])
                size = 0
            groups[-1].append(x.path)
            size += x.size
        return [Files(paths) for paths in groups] or [Files([])]

    def _wants(self, headers: dict[str, str]) -> bool:
        for header, kind, values in self.wanted:
            value = headers.get(header)
            if value is None or (kind == "in" and value not in values) or (kind == "prefix" and not value.startswith(values[0])):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(self.place)
        types = {"headers": pa.map_(pa.string(), pa.string()), "content_length": pa.int64(), "payload": pa.binary(), "payload_bytes": pa.int64()}
        schema = pa.schema([(c, pa.string()) for c in HEADERS] + list(types.items()))
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(column, t) for column, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

        for path in partition.paths:
            with system.open_input_file(path) as source:
                for row in self._records(source, path):
                    rows.append(row)
                    size += 500 + len(row[-2] or b"")
                    if size >= BATCH_BYTES:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()

    def _records(self, source, path: str) -> Iterator[tuple]:
        buffer, at = b"", 0  # bytes not used yet start at ``at``

        def more(needed: int) -> bool:
            nonlocal buffer, at
            got = source.read(max(CHUNK, needed - (len(buffer) - at)))
            buffer, at = buffer[at:] + got, 0
            return bool(got)

        while True:
            begin = at
            while (close := buffer.find(b"\r\n\r\n", begin)) < 0:
                held = len(buffer) - at
                if not more(0):
                    if buffer.strip():
                        raise ValueError(f"{path} ends inside a record's headers")
                    return
                begin = max(0, held - 3)
            lines = buffer[at:close].decode("utf-8", "replace").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"{path} has no record where one should start")
            pairs = [line.partition(":") for line in lines[1:] if ":" in line]
            headers = {name.strip().lower(): value.strip() for name, _, value in pairs}
            length = int(headers["content-length"])
            at = close + 4
            wanted, block = self._wants(headers), None
            if wanted and self.with_payload:
                while len(buffer) - at < length + 4:
                    if not more(length + 4):
                        raise ValueError(f"{path} ends inside a record")
                block = buffer[at : at + length]
            if len(buffer) - at >= length + 4:
                at += length + 4
            else:  # past the block without reading it
                end = source.tell() + length + 4 - (len(buffer) - at)
                if end > source.size():
                    raise ValueError(f"{path} ends inside a record")
                source.seek(end)
                buffer, at = b"", 0
            if wanted:
                payload, payload_bytes = None, None
                if block is not None:
                    http, _, payload = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
                    stated = [x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                    payload_bytes = int(stated[0].split(b":")[1]) if stated else len(payload)
                yield (*(headers.get(h) for h in HEADERS.values()), list(headers.items()), length, payload, payload_bytes)


def read(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """The records below ``folder``.  ``payload_bytes`` is the length that the HTTP headers state; null without payload.

    Call it once per filter: Spark keeps one reader per loaded DataFrame, and the
    predicates pushed down for one use of it would hold for the others as well.
    """
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's length and digest come from the payload read; a revisit's from
    its headers, so its scan skips all that the responses hold.  An empty table
    gives archives without records and no rows.
    """
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    write(pages, folder, **options)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    no = lambda c: F.when(number(c) != "", number(c).cast("long"))
    responses = read(spark, folder).filter("record_type = 'response'").select(
        no("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"),
        "record_type", F.lit(None).cast("long").alias("refers_to"),
    )
    revisits = read(spark, folder).filter("record_type = 'revisit'").select(
        no("record_id").alias("page_id"), "payload_bytes", F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type", no("refers_to").alias("refers_to"),
    )
    return responses.unionByName(revisits)

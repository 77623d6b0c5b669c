"""ZIP archives as two tables: their directories, and the contents of chosen members.

The directory of an archive is a few bytes at its end, so listing reads no content.
Members are then dealt out as runs - neighbours of one archive, bounded in bytes and
in number - and each is read from its own place in the file: one huge archive is
read by many tasks, and a filter on the directory keeps what isn't wanted unread.
A member streams through its checksum and digest, whatever its size.
"""

from __future__ import annotations

import bz2
import hashlib
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..session import stored_table

#: A larger member has its digest but no content cell; ``parts`` gives its content.
CELL_BYTES = (1 << 31) - 1
#: A run of members ends after this many bytes of the archive or this many members.
RUN_BYTES = 64 << 20
RUN_MEMBERS = 1000
#: More runs than this share tasks.
MOST_TASKS = 100_000
#: Bytes read at a time.
STEP = 1 << 20
#: Bytes that one step of inflating gives at most.
MOST_AT_ONCE = 8 << 20

DIRECTORY = "export_id string, path string, no bigint, rel_path string, begin bigint, stored bigint, bytes bigint, crc bigint, method int, flags int, sha256 string, open_error string"
FILES = "export_id string, rel_path string, bytes bigint, sha256 string, content binary, open_error string"
PARTS = "export_id string, rel_path string, part_no int, content binary"
#: What a damaged, encrypted or unsupported member raises.
BAD_MEMBER = (zipfile.BadZipFile, zlib.error, EOFError, OSError, RuntimeError, NotImplementedError, ValueError, struct.error)

_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _ARROW[kind]) for i, (_, kind) in enumerate(fields)], names=[n for n, _ in fields])


def _open(place: str):
    system, path = fs.FileSystem.from_uri(place)
    return system.open_input_file(path)


def _file_digest(place: str) -> str:
    """sha256 of the archive itself, read in parts: the only identity an unreadable package has."""
    digest = hashlib.sha256()
    with _open(place) as source:
        while part := source.read(STEP):
            digest.update(part)
    return digest.hexdigest()


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The directory of each archive; one that can't be opened is one row with an error and its own digest."""
    for batch in batches:
        for name, place, length in zip(*(batch.column(n).to_pylist() for n in range(3)), strict=True):
            try:
                with _open(place) as source, zipfile.ZipFile(source) as archive:
                    members = [m for m in archive.infolist() if not m.is_dir()]
            except (zipfile.BadZipFile, pa.ArrowInvalid, EOFError, OSError, ValueError, struct.error) as problem:
                yield _batch(DIRECTORY, [(name, place, -1, "", None, None, length, None, None, None, _file_digest(place), str(problem) or type(problem).__name__)])
                continue
            for begin in range(0, len(members), 10_000):
                part = enumerate(members[begin : begin + 10_000], begin)
                yield _batch(DIRECTORY, [(name, place, no, m.filename, m.header_offset, m.compress_size, m.file_size, m.CRC, m.compress_type, m.flag_bits, None, None) for no, m in part])


def directory(spark: SparkSession, root: str) -> DataFrame:
    """A row per member of every ``*.zip`` below ``root`` with its place in the archive; no content is read.

    ``export_id`` is the archive's path below ``root`` without the ending, so that
    archives of one name in different folders stay apart.  An archive that can't be
    opened is a row without a member, with ``open_error`` and its own digest.
    """
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(root).select("path", "length")
    below = F.regexp_replace(F.substring_index(F.col("path"), root.rstrip("/") + "/", -1), r"(?i)\.zip$", "")
    # Spark's local paths have one slash after the scheme, a URI has three.
    place = F.regexp_replace(F.col("path"), r"^file:/(?!/)", "file:///")
    return raw.repartition("path").select(paths.unquote(below).alias("export_id"), place.alias("path"), "length").mapInArrow(_listed, DIRECTORY)


def _inflated(pieces: Iterator[bytes], method: int) -> Iterator[bytes]:
    """Parts of bounded size, however far the data expands."""
    if method == zipfile.ZIP_STORED:
        yield from pieces
    elif method == zipfile.ZIP_DEFLATED:
        inflater = zlib.decompressobj(-15)
        for piece in pieces:
            while piece:
                yield inflater.decompress(piece, MOST_AT_ONCE)
                piece = inflater.unconsumed_tail
        yield inflater.flush()
    elif method == zipfile.ZIP_BZIP2:
        inflater = bz2.BZ2Decompressor()
        for piece in pieces:
            yield inflater.decompress(piece, MOST_AT_ONCE)
            while not inflater.needs_input and not inflater.eof:
                yield inflater.decompress(b"", MOST_AT_ONCE)
    else:
        raise NotImplementedError(f"compression method {method}")


def stream(source, begin: int, stored: int, size: int, crc: int, method: int, flags: int) -> Iterator[bytes]:
    """The content of the member whose local header starts at ``begin``, part by part; raises where it isn't what the directory says."""
    if flags & 1:
        raise RuntimeError("encrypted member")
    source.seek(begin)
    head = source.read(30)
    if head[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("no member where the directory has one")
    name, extra = struct.unpack("<26x2H", head)
    source.seek(begin + 30 + name + extra)

    def pieces() -> Iterator[bytes]:
        left = stored
        while left:
            data = source.read(min(STEP, left))
            if not data:
                raise EOFError("the archive ends inside a member")
            left -= len(data)
            yield data

    seen, found = 0, 0
    for part in _inflated(pieces(), method):
        seen, found = seen + len(part), zlib.crc32(part, found)
        if seen > size:
            break
        if part:
            yield part
    if seen != size or found != crc:
        raise zipfile.BadZipFile("size or checksum differs from the directory")


_MEMBER = ["export_id", "path", "rel_path", "begin", "stored", "bytes", "crc", "method", "flags", "sha256", "open_error"]


def members(batches: Iterator[pa.RecordBatch], cell_bytes: int = CELL_BYTES, opener: Callable = _open) -> Iterator[tuple]:
    """FILES rows of directory rows that come in the order of their archives; each archive is opened once in a run."""
    source, current = None, None
    try:
        for batch in batches:
            for export_id, place, rel_path, *where, digest, error in zip(*(batch.column(c).to_pylist() for c in _MEMBER), strict=True):
                size = where[2]
                if error is not None:
                    yield (export_id, rel_path, size, digest, None, error)
                    continue
                try:
                    if place != current:
                        if source is not None:
                            source.close()
                        source, current = opener(place), place
                    digest, kept = hashlib.sha256(), bytearray() if size < cell_bytes else None
                    for part in stream(source, *where):
                        digest.update(part)
                        if kept is not None:
                            kept += part
                    yield (export_id, rel_path, size, digest.hexdigest(), None if kept is None else bytes(kept), None)
                except BAD_MEMBER as problem:
                    yield (export_id, rel_path, size, None, None, str(problem) or type(problem).__name__)
    finally:
        if source is not None:
            source.close()


def _runs(rows: DataFrame) -> DataFrame:
    """Directory rows dealt out by archive and run, in the order of the archive.

    The rows are small whatever they stand for, so the number of tasks comes from the
    bytes and members to be read: Spark would take few rows for little work.
    """
    rows = stored_table(rows, "archive-directory")
    size = rows.agg(F.coalesce(F.sum("stored"), F.lit(0)).alias("stored"), F.count("*").alias("members")).first()
    tasks = min(MOST_TASKS, 1 + size["stored"] // RUN_BYTES + size["members"] // RUN_MEMBERS)
    run = F.struct(F.floor(F.coalesce("begin", F.lit(0)) / RUN_BYTES), F.floor(F.col("no") / RUN_MEMBERS))
    return rows.repartition(tasks, "path", run).sortWithinPartitions("path", "begin").select(_MEMBER)


def contents(rows: DataFrame, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """Content, size and digest of the members in ``rows`` (all or some rows of ``directory``).

    What can't be read is a row with ``open_error``; the others of its archive are not
    affected.  A member of ``cell_bytes`` or more has no content here, but its digest.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in members(batches, cell_bytes):
            held.append(row)
            size += len(row[4] or b"") + 200
            if size > 8 << 20:
                yield _batch(FILES, held)
                held, size = [], 0
        if held:
            yield _batch(FILES, held)

    return _runs(rows).mapInArrow(read, FILES)


def parts(rows: DataFrame, part_bytes: int = 64 << 20) -> DataFrame:
    """The content of members of any size, in numbered parts of ``part_bytes``.

    A damaged member fails the job: some of its parts would be out already.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for export_id, place, rel_path, *where, _, error in zip(*(batch.column(c).to_pylist() for c in _MEMBER), strict=True):
                if error is not None:
                    continue
                with _open(place) as source:
                    held, no = bytearray(), 0
                    for piece in stream(source, *where):
                        held += piece
                        while len(held) >= part_bytes:
                            yield _batch(PARTS, [(export_id, rel_path, no, bytes(held[:part_bytes]))])
                            del held[:part_bytes]
                            no += 1
                    if held or not no:
                        yield _batch(PARTS, [(export_id, rel_path, no, bytes(held))])

    return _runs(rows).mapInArrow(read, PARTS)


def scan(spark: SparkSession, root: str, wanted: Column | None = None) -> DataFrame:
    """Members of every archive below ``root``; ``wanted`` is a condition on directory columns (export_id, rel_path, bytes)."""
    rows = directory(spark, root)
    return contents(rows if wanted is None else rows.filter(wanted | F.col("open_error").isNotNull()))


def write(files: DataFrame, folder: str) -> None:
    """One ``<export_id>.zip`` in ``folder`` for each package of ``files`` (export_id, rel_path, content), members by path.

    A package streams through one task in the order of its paths and is moved to its
    name when it is whole, so that a repeated task never leaves half an archive.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        current, archive, sink, draft = None, None, None, None

        def finish() -> None:
            if archive is not None:
                archive.close()
                sink.close()
                system.move(draft, f"{base}/{current}.zip")

        done = []
        for batch in batches:
            for export_id, rel_path, content in zip(*(batch.column(n).to_pylist() for n in range(3)), strict=True):
                if export_id != current:
                    finish()
                    draft = f"{base}/_draft-{uuid.uuid4().hex}"
                    current, sink = export_id, system.open_output_stream(draft)
                    archive = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED)
                    done.append(export_id)
                archive.writestr(rel_path, content or b"")
        finish()
        yield _batch("export_id string", [(x,) for x in done])

    uri = folder if "://" in folder else f"file://{folder}"
    folder = uri
    ordered = files.select("export_id", "rel_path", "content").repartition("export_id").sortWithinPartitions("export_id", "rel_path")
    ordered.mapInArrow(written, "export_id string").write.format("noop").mode("overwrite").save()

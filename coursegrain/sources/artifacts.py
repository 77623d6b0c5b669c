"""Written files and what is really there: one file a row out, one digest a file back."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored_table

#: Bytes and files that a task digests, and packages that one lists.
TASK_BYTES = 256 << 20
TASK_FILES = 2000
TASK_PACKAGES = 200
MOST_TASKS = 100_000
STEP = 1 << 20


def write(files: DataFrame, folder: str) -> None:
    """Every row (export_id, rel_path, content) as a file ``folder/export_id/rel_path``.

    A file gets its name when it is whole, so a repeated task leaves no half of one.
    Null content is an empty file.  Paths that would leave the folder are an error.
    """
    root = _root(folder)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(root)
        made = set()
        for batch in batches:
            for export_id, rel_path, content in zip(*(batch.column(n).to_pylist() for n in range(3)), strict=True):
                parts = [export_id, *rel_path.split("/")]
                if any(p in ("", ".", "..") for p in parts):
                    raise ValueError(f"unsafe artifact path {export_id}/{rel_path}")
                place = "/".join([base, *parts])
                above = place.rpartition("/")[0]
                if above not in made:
                    system.create_dir(above, recursive=True)
                    made.add(above)
                draft = f"{above}/_draft-{uuid.uuid4().hex}"
                with system.open_output_stream(draft) as sink:
                    sink.write(content or b"")
                system.move(draft, place)
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["export_id"])

    files.select("export_id", "rel_path", "content").mapInArrow(written, "export_id string").write.format("noop").mode("overwrite").save()


def _root(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """export_id, rel_path, bytes and sha256 of every file below ``folder``, empty ones too; the first folder is the package.

    The driver lists the packages only; tasks list what is in them.  A file streams
    through its digest in parts, whatever its size; drafts of lost tasks are passed over.
    """
    root = _root(folder)
    system, base = fs.FileSystem.from_uri(root)
    names = [(x.base_name,) for x in system.get_file_info(fs.FileSelector(base, allow_not_found=True)) if x.type == fs.FileType.Directory]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                found = [x for x in system.get_file_info(fs.FileSelector(f"{base}/{name}", recursive=True)) if x.type == fs.FileType.File and not x.base_name.startswith("_draft-")]
                paths = [x.path.removeprefix(f"{base}/{name}/") for x in found]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array(paths, pa.string()), pa.array([x.size for x in found], pa.int64())], ["export_id", "rel_path", "bytes"])

    packages = spark.createDataFrame(names, "export_id string")
    kept = stored_table(packages.repartition(min(MOST_TASKS, 1 + len(names) // TASK_PACKAGES), "export_id").mapInArrow(listed, "export_id string, rel_path string, bytes bigint"), "artifact-list")
    size = kept.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count("*").alias("files")).first()
    tasks = min(MOST_TASKS, 1 + size["bytes"] // TASK_BYTES + size["files"] // TASK_FILES)

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            found = []
            for name, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                digest = hashlib.sha256()
                with system.open_input_stream(f"{base}/{name}/{path}") as source:
                    while part := source.read(STEP):
                        digest.update(part)
                found.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], ["export_id", "rel_path", "bytes", "sha256"])

    return kept.repartition(tasks, "export_id", "rel_path").mapInArrow(digested, "export_id string, rel_path string, bytes bigint, sha256 string")

"""Monthly zip archives, unpacked into the raw zone by tasks."""

from __future__ import annotations

import posixpath
import shutil
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stationflow.session import shared_root
from stationflow.sources.files import filesystem_of, list_files, one_task_each, open_uri

CHUNK_BYTES = 1 << 20
# What a missing, cut or damaged archive raises.
UNREADABLE = (zipfile.BadZipFile, zlib.error, OSError, EOFError, ValueError)


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for path in batch["path"]:
            try:
                with open_uri(path) as raw, zipfile.ZipFile(raw) as archive:
                    found += [(path, m.filename, m.file_size, None) for m in archive.infolist() if not m.is_dir()]
            except UNREADABLE as error:
                found.append((path, None, None, str(error)))
        yield pd.DataFrame(found, columns=["path", "member", "length", "error"]).astype({"length": "Int64"})


def list_members(spark: SparkSession, pattern: str) -> DataFrame:
    """``path, member, length, error`` of all files in the matching archives.

    Only the archives' directories are read; an unreadable archive gives one row with an error.
    """
    archives = one_task_each(list_files(spark, pattern).select("path"), ["path"])
    return archives.mapInPandas(_members, "path string, member string, length long, error string")


def extract_archives(spark: SparkSession, pattern: str, raw_dir: str) -> DataFrame:
    """Unpack every member of every matching archive into ``raw_dir``; return what was written.

    One task per member, copied as a stream in small chunks, so memory does not grow with the
    file.  A member is written under a name of its own and moved into place when complete:
    a task that is run again, or lost half-way, leaves no half file.  A name that several archives
    hold gets the archive's name added before its ending, so that no member replaces another.  The result
    (``path, member, target, error``) is fixed in the checkpoint folder.
    """

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, base = filesystem_of(raw_dir)
        for batch in batches:
            done = []
            for path, member, shared in zip(batch["path"], batch["member"], batch["shared"]):
                name = posixpath.normpath(member)
                if shared:
                    # Another archive has a member of this name: the archive's own name tells them apart.
                    stem, dot, kind = name.rpartition(".")
                    own = posixpath.splitext(posixpath.basename(path))[0]
                    name = f"{stem}.{own}{dot}{kind}" if dot else f"{name}.{own}"
                target = posixpath.join(base, name)
                part = f"{target}.{uuid.uuid4().hex}.part"
                if name.startswith(("/", "..")):
                    done.append((path, member, None, "member outside the target folder"))
                    continue
                try:
                    filesystem.create_dir(posixpath.dirname(target), recursive=True)
                    with open_uri(path) as raw, zipfile.ZipFile(raw) as archive, archive.open(member) as source:
                        with filesystem.open_output_stream(part) as sink:
                            shutil.copyfileobj(source, sink, CHUNK_BYTES)
                    filesystem.move(part, target)
                    done.append((path, member, f"{raw_dir}/{name}", None))
                except UNREADABLE as error:
                    done.append((path, member, None, str(error)))
            yield pd.DataFrame(done, columns=["path", "member", "target", "error"])

    shared_root(spark)
    members = list_members(spark, pattern).checkpoint()
    schema = "path string, member string, target string, error string"
    twins = F.count(F.lit(1)).over(Window.partitionBy("member")) > 1
    readable = members.where(F.col("error").isNull()).select("path", "member", twins.alias("shared"))
    unpacked = one_task_each(readable, ["path", "member"]).mapInPandas(unpack, schema)
    broken = members.where(F.col("error").isNotNull()).select(
        "path", "member", F.lit(None).cast("string").alias("target"), "error"
    )
    return unpacked.unionByName(broken).checkpoint()

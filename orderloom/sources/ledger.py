"""Ledgers: what a stored table consists of, as numbered small files.

Data is written to a folder of its own first; the folder counts from the moment
a ledger entry names it. An entry is complete before its name appears, and a
name is given once only: of two writers that want the same number one succeeds,
and the other looks at the new state and tries again. So a job that is killed
while it writes changes nothing, and readers always see whole tables.

The folder has to be on a file system where a rename never replaces a file, as
in HDFS, or on a mounted one with hard links.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LEDGER = "_ledger"
RUNS = "_runs"

_READ: dict[str, dict] = {}


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    found, fs = _path(spark, path)
    fs.delete(found, True)


def entries(spark: SparkSession, path: str) -> list[dict]:
    """The entries in order, each with its ``number``; none if there is no ledger.

    Entries never change, so each is read once per session.
    """
    folder, fs = _path(spark, f"{path}/{LEDGER}")
    if not fs.exists(folder):
        return []
    out = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if not name.isdigit():
            continue
        # a name that was deleted with its table and given again has another time
        slot = f"{status.getPath()}@{status.getModificationTime()}"
        if slot not in _READ:
            stream = fs.open(status.getPath())
            try:
                text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            _READ[slot] = {**json.loads(text), "number": int(name)}
        out.append(_READ[slot])
    return sorted(out, key=lambda e: e["number"])


def commit(spark: SparkSession, path: str, number: int, entry: dict) -> bool:
    """Enter ``entry`` under ``number``; False if another writer has that number."""
    target, fs = _path(spark, f"{path}/{LEDGER}/{number:012d}")
    draft, _ = _path(spark, f"{path}/{LEDGER}/.draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps(entry).encode()))
    stream.close()
    try:
        if fs.getUri().getScheme() != "file":
            return bool(fs.rename(draft, target))
        # a local rename would replace the file; a link does not
        name = lambda p: spark._jvm.java.io.File(p.toUri().getPath()).toPath()
        spark._jvm.java.nio.file.Files.createLink(name(target), name(draft))
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(draft, False)


def next_number(known: list[dict]) -> int:
    return known[-1]["number"] + 1 if known else 1


def new_folder(path: str) -> str:
    """A folder for data that no entry names yet; readers of ``path`` do not see it."""
    return f"{path}/{RUNS}/{uuid.uuid4().hex}"

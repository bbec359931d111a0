"""A log of numbered commits in a folder; of two writers of one number, one fails.

A commit is a small file that is written aside and then renamed to its number without replacing what is there. Readers
see the last number, whole, or the one before.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from clearspan.sources.readers import path_exists


class ConflictError(RuntimeError):
    """Another writer has committed in the meantime."""


def _store(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def entries(spark: SparkSession, folder: str, after: int = 0) -> list[tuple[int, dict]]:
    """Numbers above ``after`` and what was committed under them, in order."""
    if not path_exists(spark, folder):
        return []
    path, store = _store(spark, folder)
    names = [(s.getPath().getName(), s.getPath()) for s in store.listStatus(path)]
    found = []
    for name, file in sorted(n for n in names if n[0].isdigit()):
        if int(name) > after:
            stream = store.open(file)
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            found.append((int(name), json.loads(text)))
    return found


def latest(spark: SparkSession, folder: str) -> tuple[int, dict | None]:
    """The last number and its value; 0 and None before the first commit."""
    if not path_exists(spark, folder):
        return 0, None
    path, store = _store(spark, folder)
    numbers = [int(n) for n in (s.getPath().getName() for s in store.listStatus(path)) if n.isdigit()]
    return entries(spark, folder, max(numbers) - 1)[-1] if numbers else (0, None)


def commit(spark: SparkSession, folder: str, after: int, value: dict) -> int:
    """Commit ``value`` under the number that follows ``after``; fails if that number is taken."""
    number = after + 1
    aside, store = _store(spark, f"{folder}/.{uuid.uuid4().hex}")
    stream = store.create(aside, False)
    stream.write(bytearray(json.dumps(value).encode()))
    stream.close()
    target, _ = _store(spark, f"{folder}/{number:020d}")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration())
    try:
        _rename(spark, context, aside, target)
    except Exception as error:
        store.delete(aside, False)
        if "FileAlreadyExists" in str(error):
            raise ConflictError(f"{folder}: commit {number} is taken") from error
        raise
    return number


def _rename(spark: SparkSession, context, source, target) -> None:
    """Fails if the target is there, as the option to overwrite is not given."""
    kind = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context.rename(source, target, options)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing refers to."""
    target, store = _store(spark, path)
    store.delete(target, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    source, store = _store(spark, path)
    target, _ = _store(spark, to)
    if not store.rename(source, target):
        raise OSError(f"{path} could not be moved to {to}")

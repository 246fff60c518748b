"""Files in the shared folder, written and read by Python workers through any file system pyarrow knows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Tasks that read a list of files, at most; with more files a task reads several, one after the other.
MAX_TASKS = 8192


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


@contextmanager
def atomic_writer(folder: str, name: str) -> Iterator:
    """A stream to ``folder/name``; the file appears whole or not at all, so a repeated task only replaces it."""
    system, path = open_fs(folder)
    system.create_dir(path, recursive=True)
    made = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(made, compression=None) as out:
        yield out
    system.move(made, f"{path}/{name}")


def reader(uri: str):
    system, path = open_fs(uri)
    return system.open_input_stream(path, compression=None)


def attempt_name(stem: str, file: int, suffix: str) -> str:
    """A file name of this task attempt alone: another attempt of the task never replaces a file that a committed one has listed."""
    context = TaskContext.get()
    return f"{stem}-{context.partitionId():06d}-{file:04d}-{context.taskAttemptId()}{suffix}"


def deal(files: DataFrame) -> DataFrame:
    """The rows, one per file, dealt evenly over one task per file or MAX_TASKS."""
    return files.repartition(max(1, min(files.count(), MAX_TASKS)))

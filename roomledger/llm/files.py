"""Binary files of tasks in a folder that all machines share.

A task writes under the name of its attempt and renames at the end, so a file
of a given name is always whole, whichever attempt was the last.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import NativeFile, fs
from pyspark import TaskContext
from pyspark.sql import SparkSession

from roomledger.session import new_run_dir


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, as a full address that tasks can open."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(new_run_dir(spark, label))
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(hadoop)
    return system.makeQualified(hadoop).toString()


@contextmanager
def written(folder: str, name: str) -> Iterator[NativeFile]:
    """The file of a task, visible under its name only when complete."""
    system, path = fs.FileSystem.from_uri(folder)
    draft = f"{path}/.{name}.{TaskContext.get().taskAttemptId()}"
    with system.open_output_stream(draft) as out:
        yield out
    system.move(draft, f"{path}/{name}")


@contextmanager
def opened(folder: str, name: str) -> Iterator[NativeFile]:
    system, path = fs.FileSystem.from_uri(folder)
    with system.open_input_file(f"{path}/{name}") as source:
        yield source

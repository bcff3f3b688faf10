"""Arrays that tasks write to and read from the folder that the cluster shares."""

from __future__ import annotations

import io
import os
import uuid

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tidyledger.llm.common import checkpointed


def new_folder(spark: SparkSession, kind: str) -> str:
    """A new folder below the one that all executors share, as a URI."""
    checkpointed(spark.range(1))  # sets a folder where none is set
    base = spark.sparkContext.getCheckpointDir()
    uri = base if "://" in base or base.startswith("file:") else f"file://{os.path.abspath(base)}"
    uri = uri.replace("file:///", "file:/").replace("file:/", "file:///")
    folder = f"{uri}/{kind}-{uuid.uuid4().hex}"
    filesystem, path = fs.FileSystem.from_uri(folder)
    filesystem.create_dir(path)
    return folder


def store(folder: str, name: str, data: bytes | memoryview) -> None:
    """Write a file whole or not at all, so that a repeated task does no harm."""
    filesystem, path = fs.FileSystem.from_uri(folder)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with filesystem.open_output_stream(draft) as out:
        out.write(data)
    filesystem.move(draft, f"{path}/{name}")


def store_arrays(folder: str, arrays: dict[str, np.ndarray]) -> str:
    """Write the arrays as one file of a name that no other task uses; the name."""
    name = uuid.uuid4().hex
    buffer = io.BytesIO()
    np.savez(buffer, **arrays)
    store(folder, name, buffer.getbuffer())
    return name


def load_arrays(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a file that `store_arrays` wrote."""
    filesystem, path = fs.FileSystem.from_uri(folder)
    with filesystem.open_input_file(f"{path}/{name}") as source:
        return dict(np.load(io.BytesIO(source.read()), allow_pickle=False))


class Blocks:
    """Files of arrays that a task goes through again and again, one in memory at a time."""

    def __init__(self, folder: str, names: list[str]):
        self.folder, self.names = folder, names
        self._held: tuple[str, object] | None = None

    def each(self, made):
        """`made(arrays)` for each file; that of the last file is kept for the next round."""
        held = self._held[0] if self._held else None
        # The one in memory comes first.
        for name in sorted(self.names, key=lambda n: n != held):
            if self._held is None or self._held[0] != name:
                self._held = None
                self._held = (name, made(load_arrays(self.folder, name)))
            yield self._held[1]


def written(df: DataFrame, kind: str) -> DataFrame:
    """`df` as Parquet in a new shared folder, read back."""
    path = f"{new_folder(df.sparkSession, kind)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Files that executors write and read in the shared folder."""

from __future__ import annotations

import uuid
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame

#: The folder that holds the package.
ROOT = str(Path(__file__).resolve().parents[2])


def mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` whose workers also look for this package where the driver found it.

    A cluster installs the package or ships it with the job; on one machine the
    driver's import path is not the workers'.
    """
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return df.mapInArrow(fn, schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def at(uri: str) -> tuple[fs.FileSystem, str]:
    """The filesystem and plain path of a local path or a URI."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def fresh(folder: str, name: str) -> str:
    """A file name no other task attempt uses: files of failed attempts are never in a manifest."""
    store, path = at(folder)
    store.create_dir(path, recursive=True)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def one_task_each(manifest: pa.Table, df_of) -> DataFrame:
    """A manifest (one row per file) as a frame whose rows are dealt over as many tasks.

    Round robin over a local table is the same on every run of a task.
    """
    df = df_of(manifest)
    return df.repartition(max(1, manifest.num_rows))

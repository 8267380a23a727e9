"""Files in shared storage, and objects kept by a worker process."""

from __future__ import annotations

import contextlib
import os
import pickle
import sys
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession

_KEPT = "_clickspark_llm_kept"


_MOST_KEPT = 2


def kept(name: Any, make: Callable[[], Any]) -> Any:
    """An object that the tasks of one worker process share, made by the first. The
    process keeps the two used last: what earlier stages kept goes."""
    held = sys.modules.setdefault(_KEPT, types.ModuleType(_KEPT)).__dict__.setdefault("objects", {})
    found = held.pop(name) if name in held else make()
    held[name] = found
    while len(held) > _MOST_KEPT:
        del held[next(iter(held))]
    return found


class Sent:
    """A broadcast object whose class workers need not know: sent as bytes that hold
    the class too, and made from them once in a worker process."""

    def __init__(self, spark: SparkSession, value: Any):
        self.key = uuid.uuid4().hex
        self.data = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self) -> Any:
        return kept(("sent", self.key), lambda: pickle.loads(self.data.value))


def _local(path: str) -> str | None:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if "://" not in path else None


def _system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path)


def opened(path: str):
    """A binary file, open for reading at any position."""
    if (local := _local(path)) is not None:
        return open(local, "rb")
    system, name = _system(path)
    return system.open_input_file(name)


@contextlib.contextmanager
def created(path: str) -> Iterator[Any]:
    """A binary file to write. It gets its name when it is whole, so a task that
    runs twice or is lost leaves no broken file under that name."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    if (local := _local(path)) is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(_local(part), "wb") as out:
            yield out
        os.replace(_local(part), local)
        return
    system, name = _system(path)
    with system.open_output_stream(_system(part)[1]) as out:
        yield out
    system.move(_system(part)[1], name)


def make_folder(path: str) -> None:
    if (local := _local(path)) is not None:
        os.makedirs(local, exist_ok=True)
    else:
        system, name = _system(path)
        system.create_dir(name)


def size_of(path: str) -> int:
    if (local := _local(path)) is not None:
        return os.path.getsize(local)
    system, name = _system(path)
    return system.get_file_info(name).size


def listed(path: str, suffix: str) -> list[str]:
    """Files of a folder by name; of a file, itself."""
    if (local := _local(path)) is not None:
        if os.path.isfile(local):
            return [path]
        return sorted(f"{path.rstrip('/')}/{n}" for n in os.listdir(local) if n.endswith(suffix))
    system, name = _system(path)
    if system.get_file_info(name).type == pyarrow.fs.FileType.File:
        return [path]
    found = system.get_file_info(pyarrow.fs.FileSelector(name))
    base = path.rstrip("/")
    return sorted(f"{base}/{x.base_name}" for x in found if x.base_name.endswith(suffix))

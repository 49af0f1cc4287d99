"""Outputs that take their place only when they are complete.

A folder is written aside, next to its place, and then renamed into it. A marker names the two folders in question while they
change places, so that whoever comes next can finish or undo a change of places that was cut short. What fails
earlier leaves the last good output as it is. On file systems that copy for a rename, the change takes as long as the copy.
"""

from collections.abc import Callable
from typing import TypeVar
from uuid import uuid4

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

T = TypeVar("T")


def publish(spark: SparkSession, path: str, write: Callable[[str], T]) -> T:
    """Have `write` fill a folder of its own and put that in the place of `path`; returns what `write` does."""
    recover(spark, path)
    places = _Places(spark, path)
    new, old = places.beside(f"{uuid4().hex}.new"), places.beside(f"{uuid4().hex}.old")
    try:
        result = write(new.toString())
        places.mark(new, old)
    except Exception:
        places.fs.delete(new, True)
        raise
    places.change(new, old)
    return result


def recover(spark: SparkSession, path: str) -> None:
    """Finish a change of places that was cut short. The marker is set only when the new folder is complete."""
    places = _Places(spark, path)
    if places.fs.exists(places.marker):
        new, old = (places.beside(name) for name in places.marked())
        if places.fs.exists(new):
            places.change(new, old)
        else:
            places.clear(old)


class _Places:
    """The place of an output, and the names beside it. Names that begin with a dot are not read as data."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.target = self.jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
        self.fs = self.target.getFileSystem(spark._jsc.hadoopConfiguration())
        self.marker = self.beside("publishing")

    def beside(self, name: str) -> JavaObject:
        own = f".{self.target.getName()}."
        name = name if name.startswith(own) else f"{own}{name}"
        parent = self.target.getParent()
        path = self.jvm.org.apache.hadoop.fs.Path
        return path(name) if parent is None else path(parent, name)

    def mark(self, new: JavaObject, old: JavaObject) -> None:
        # Written under another name first: a marker is whole or not there.
        draft = self.beside(f"{uuid4().hex}.marker")
        out = self.fs.create(draft, True)
        out.write(bytearray(f"{new.getName()}\n{old.getName()}".encode()))
        out.close()
        if not self.fs.rename(draft, self.marker):
            raise OSError(f"cannot mark {self.target} as being published")

    def marked(self) -> list[str]:
        stream = self.fs.open(self.marker)
        try:
            names = bytes(stream.readAllBytes()).decode().split("\n")
        finally:
            stream.close()
        return names

    def change(self, new: JavaObject, old: JavaObject) -> None:
        if not self.fs.exists(old) and self.fs.exists(self.target) and not self.fs.rename(self.target, old):
            raise OSError(f"cannot move {self.target} aside")
        if not self.fs.rename(new, self.target):
            if self.fs.exists(old):
                self.fs.rename(old, self.target)
            raise OSError(f"cannot move the new folder to {self.target}")
        self.clear(old)

    def clear(self, old: JavaObject) -> None:
        self.fs.delete(self.marker, False)
        self.fs.delete(old, True)

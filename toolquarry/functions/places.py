"""Moving what has been written into its place, so that a whole version survives a killed run."""

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def beside(path: str, kind: str) -> str:
    """A new path next to ``path`` for a version of it: ``new`` or ``old``."""
    return f"{path.rstrip('/')}.{kind}-{uuid.uuid4().hex}"


def _versions(spark: SparkSession, path: str, kind: str) -> list:
    """Versions that runs have left beside ``path``, the latest first."""
    files, target = file_system(spark, path.rstrip("/"))
    parent, start = target.getParent(), f"{target.getName()}.{kind}-"
    if parent is None or not files.exists(parent):
        return []
    found = [s for s in files.listStatus(parent) if s.getPath().getName().startswith(start)]
    return [s.getPath() for s in sorted(found, key=lambda s: -s.getModificationTime())]


def recover(spark: SparkSession, path: str) -> bool:
    """Take up the version that a killed run had moved aside, if there is none in its place.

    True if there is a version at ``path`` now.
    """
    files, target = file_system(spark, path.rstrip("/"))
    if files.exists(target):
        return True
    return any(files.rename(old, target) for old in _versions(spark, path, "old")[:1])


def put(spark: SparkSession, new: str, path: str) -> None:
    """Put what was written at ``new`` in the place of ``path``; one writer at a time.

    What stood there is moved aside first and deleted last, together with what killed runs
    left. Whenever a run dies, a whole version is at ``path`` or is brought back by ``recover``.
    """
    files, target = file_system(spark, path.rstrip("/"))
    if recover(spark, path):
        files.rename(target, file_system(spark, beside(path, "old"))[1])
    elif target.getParent() is not None:
        files.mkdirs(target.getParent())
    if not files.rename(file_system(spark, new)[1], target):
        raise OSError(f"{new} could not be moved to {path}")
    for kind in ("old", "new"):
        for left in _versions(spark, path, kind):
            files.delete(left, True)


def join_parts(spark: SparkSession, folder: str, path: str, head: str, tail: str, drop: int) -> None:
    """One file of the text parts of ``folder`` in their order, between ``head`` and ``tail``.

    The last ``drop`` bytes of the parts are left out. The parts have been written by many
    tasks; here they only stream through, one after the other.
    """
    jvm, (files, target) = spark._jvm, file_system(spark, path)
    parts = [s for s in files.listStatus(file_system(spark, folder)[1]) if s.getPath().getName().startswith("part-")]
    parts = sorted((s for s in parts if s.getLen()), key=lambda s: s.getPath().getName())
    out = files.create(target, True)
    try:
        out.write(bytearray(head.encode()))
        for i, part in enumerate(parts):
            source = files.open(part.getPath())
            size = part.getLen() - (drop if i + 1 == len(parts) else 0)
            jvm.org.apache.commons.io.IOUtils.copyLarge(source, out, 0, size)
            source.close()
        out.write(bytearray(tail.encode()))
    finally:
        out.close()

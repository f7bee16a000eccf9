"""Small files and whole documents on whatever file system a path names, as Spark's own writers see it."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession


def _system(spark: SparkSession, path: str):
    """(file system, path) of the JVM; local files go without checksum files, as people edit them."""
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = held.getFileSystem(spark._jsc.hadoopConfiguration())
    return (system.getRaw() if system.getScheme() == "file" else system), held


def make_folder(spark: SparkSession, path: str) -> None:
    system, held = _system(spark, path)
    system.mkdirs(held)


def exists(spark: SparkSession, path: str) -> bool:
    system, held = _system(spark, path)
    return system.exists(held)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in place of one that is there."""
    system, held = _system(spark, path)
    out = system.create(held, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole."""
    system, held = _system(spark, path)
    data = system.open(held)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")
    finally:
        data.close()


def listed(spark: SparkSession, path: str, ending: str = "") -> list[tuple[str, int]]:
    """(path, bytes) of the files under a folder, or of the file itself, in the order of their paths."""
    system, held = _system(spark, path)
    found, at = [], system.listFiles(held, True)
    while at.hasNext():
        status = at.next()
        if (name := status.getPath().toString()).endswith(ending):
            found.append((name, status.getLen()))
    return sorted(found)


def write_document(spark: SparkSession, path: str, sections: list[str | tuple[DataFrame, list[str | Column], str, bool]]) -> None:
    """One file of sections: texts, and tables (rows with `value`, their order, what stands between rows, whether it also ends them).

    Tasks write the rows of a table as sorted parts beside the file; then the JVM of the driver copies the parts, in order,
    by a small buffer, to a temporary name, which takes the file's place last.  No row passes through Python.
    """
    mark = uuid.uuid4().hex
    system, target = _system(spark, path)
    temporary, parts = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{mark}"), f"{path}.{mark}.parts"
    copy = spark._jvm.org.apache.commons.io.IOUtils.copyLarge
    try:
        for k, section in enumerate(sections):
            if not isinstance(section, str):
                rows, order, between, _ = section
                rows.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.option("lineSep", between).text(f"{parts}/{k}")
        out = system.create(temporary, True)
        try:
            for k, section in enumerate(sections):
                if isinstance(section, str):
                    out.write(bytearray(section.encode("utf-8")))
                    continue
                files = [(int(name.rsplit("/part-", 1)[1].split("-")[0]), name, size) for name, size in listed(spark, f"{parts}/{k}") if "/part-" in name and size]
                files.sort()
                for i, (_, name, size) in enumerate(files):
                    last = i == len(files) - 1 and not section[3]
                    data = system.open(spark._jvm.org.apache.hadoop.fs.Path(name))
                    try:
                        copy(data, out, 0, size - (len(section[2].encode("utf-8")) if last else 0))
                    finally:
                        data.close()
        finally:
            out.close()
        system.delete(target, False)
        if not system.rename(temporary, target):
            raise OSError(f"{path} could not be put in its place")
    finally:
        for left in (temporary, spark._jvm.org.apache.hadoop.fs.Path(parts)):
            system.delete(left, True)

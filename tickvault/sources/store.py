"""Small files of the driver in whatever store Spark writes to, by Hadoop's file systems."""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def find(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Paths of the files below root whose name matches, sorted. Spark's readers pass over names that begin with an underscore; this does not."""
    fs, p = _at(spark, root)
    found, names = [], re.compile(pattern)
    files = fs.listFiles(p, True)
    while files.hasNext():
        path = files.next().getPath()
        if names.fullmatch(path.getName()):
            found.append(path.toUri().toString())
    return sorted(found)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes beside the path and renames over it, so readers see the old text or the new one."""
    fs, p = _at(spark, path)
    _, part = _at(spark, path + ".part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(part), fs.makeQualified(p), options)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value) -> None:
    write_text(spark, path, json.dumps(value, indent=2, sort_keys=True, default=str) + "\n")


def read_json(spark: SparkSession, path: str):
    """None for a file that is missing or no JSON."""
    text = read_text(spark, path)
    try:
        return None if text is None else json.loads(text)
    except ValueError:
        return None


def replace_dir(spark: SparkSession, staged: str, final: str) -> None:
    """Puts a staged folder in place of another. The old one is renamed aside first and deleted last; `recovered` brings it back after a crash in between."""
    fs, a = _at(spark, staged)
    _, b = _at(spark, final)
    _, old = _at(spark, final.rstrip("/") + ASIDE)
    recovered(spark, final)
    fs.mkdirs(b.getParent())
    if fs.exists(b) and not fs.rename(b, old):
        raise OSError(f"{final} could not be put aside")
    if not fs.rename(a, b):
        fs.rename(old, b)
        raise OSError(f"{staged} could not become {final}")
    fs.delete(old, True)


#: Ending of the name of a folder that is being replaced.
ASIDE = "._old"


def recovered(spark: SparkSession, final: str) -> bool:
    """Undoes a replacement that stopped half-way: the old folder comes back if there is no new one, else it goes. Whether there is a folder."""
    fs, b = _at(spark, final)
    _, old = _at(spark, final.rstrip("/") + ASIDE)
    if fs.exists(old):
        if fs.exists(b):
            fs.delete(old, True)
        else:
            fs.rename(old, b)
    return fs.exists(b)

"""Small files and listings through Spark's file systems, on the driver: catalogues, markers, configurations, tables for people.

Spark's readers skip names that begin with a dot; markers do, so folders are listed here."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def plain(uri: str) -> str:
    """A path of the local file system without its scheme; others as they are."""
    return "/" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else uri


def qualified(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    return plain(fs.makeQualified(p).toString())


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def walk(spark: SparkSession, root: str) -> list[tuple[str, int]]:
    """Path below root and size of each file, hidden ones too; nothing if root isn't there."""
    fs, p = _at(spark, root)
    if not fs.exists(p):
        return []
    top, found, out = qualified(spark, root).rstrip("/") + "/", fs.listFiles(p, True), []
    while found.hasNext():
        f = found.next()
        out.append((plain(f.getPath().toString()).removeprefix(top), f.getLen()))
    return sorted(out)


def folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders in root."""
    fs, p = _at(spark, root)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def _replace(spark: SparkSession, made: str, path: str) -> None:
    """Puts a file in another's place in one step: readers see the old one or the new one."""
    (fs, src), dst = _at(spark, made), _at(spark, path)[1]
    if fs.exists(dst) and fs.getFileStatus(dst).isDirectory():
        fs.delete(dst, True)
    fs.mkdirs(dst.getParent())
    how = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    how[0] = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(src), fs.makeQualified(dst), how)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    made = f"{path}.{uuid.uuid4().hex}"
    fs, p = _at(spark, made)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    _replace(spark, made, path)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def _beside(path: str, kind: str) -> str:
    at = path.rstrip("/").rfind("/") + 1
    return f"{path[:at]}{kind}/{path.rstrip('/')[at:]}"


def making(spark: SparkSession, path: str) -> str:
    """A new folder in which what shall be `path` is made, beside it; those that stopped runs left of it are deleted. Names that begin with an underscore are no datasets or chunks."""
    top, _, name = _beside(path, "_making").rpartition("/")
    for old in folders(spark, top):
        if re.fullmatch(f"{re.escape(name)}-[0-9a-f]{{32}}", old):
            delete(spark, f"{top}/{old}")
    return f"{top}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, made: str) -> None:
    """Deletes a folder and, where nothing else is in it, the one around it."""
    fs, p = _at(spark, made)
    fs.delete(p, True)
    if fs.exists(p.getParent()) and not len(fs.listStatus(p.getParent())):
        fs.delete(p.getParent(), False)


def recover(spark: SparkSession, path: str) -> None:
    """Brings back the former folder where a run was stopped between `publish`'s two steps."""
    fs, p = _at(spark, path)
    old = _at(spark, _beside(path, "_former"))[1]
    if fs.exists(old):
        if not fs.exists(p):
            fs.rename(old, p)
        discard(spark, _beside(path, "_former"))


def publish(spark: SparkSession, made: str, path: str) -> None:
    """Puts a whole folder in another's place by renaming: the former one is moved aside, the new one takes its name, then the former one is deleted.

    A run that is stopped before leaves the former one as it was; between the steps `recover` brings it back."""
    recover(spark, path)
    fs, p = _at(spark, path)
    old = _at(spark, _beside(path, "_former"))[1]
    fs.mkdirs(old.getParent())
    fs.mkdirs(p.getParent())
    if fs.exists(p) and not fs.rename(p, old):
        raise OSError(f"cannot move {path}")
    if not fs.rename(_at(spark, made)[1], p):
        recover(spark, path)
        raise OSError(f"cannot move {made} to {path}")
    discard(spark, _beside(path, "_former"))


def read_text(spark: SparkSession, path: str) -> str:
    return "".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, in the order of the rows; for tables for people (wide counts, summaries), written by one task."""
    spark = df.sparkSession
    part = f"{path}.{uuid.uuid4().hex}"
    df.coalesce(1).write.option("header", "true").option("emptyValue", "").csv(part)
    fs, p = _at(spark, part)
    made = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")]
    if made:
        _replace(spark, made[0].toString(), path)
    else:
        write_text(spark, path, ",".join(df.columns) + "\n")
    fs.delete(p, True)


def write_json(df: DataFrame, path: str) -> None:
    """The only row of df as a JSON document."""
    write_text(df.sparkSession, path, df.toJSON().first() + "\n")

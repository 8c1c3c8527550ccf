"""Small files on the table store, through the Hadoop file system of the session.

Any scheme that Spark reads works here too.  Only ``exists`` tells that a path
is absent; every other failure (network, permission, broken file) is raised.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; the folder must exist."""
    fs, p = _open(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, modification time) of every file below ``path``, which Spark lists as well to plan a scan."""
    fs, p = _open(spark, path)
    out, it = [], fs.listFiles(p, True)
    while it.hasNext():
        s = it.next()
        out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(out)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream).decode()
    finally:
        stream.close()


#: Schemes whose rename fails if the target exists, checked and done as one step.
RENAMES_ATOMICALLY = {"hdfs", "viewfs", "ofs", "o3fs", "abfs", "abfss"}
#: Schemes whose create refuses an existing file, checked and done as one step by the store.
CREATES_ATOMICALLY = {"gs", "wasb", "wasbs"}
#: Option by which other stores promise the same for one create.
CONDITIONAL_CREATE = "fs.option.create.conditional.overwrite"


def _write(stream, text: str) -> None:
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _by_link(spark: SparkSession, path: str, text: str) -> None:
    """Local disk: written aside, then linked to its name, which fails if the name is taken."""
    jvm, (fs, p) = spark._jvm, _open(spark, path)
    _, aside = _open(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    _write(fs.create(aside, False), text)
    try:
        file = jvm.java.io.File
        jvm.java.nio.file.Files.createLink(file(p.toUri().getPath()).toPath(), file(aside.toUri().getPath()).toPath())
    finally:
        fs.delete(aside, False)


def _by_rename(spark: SparkSession, path: str, text: str) -> None:
    """Written aside, then renamed without overwriting."""
    jvm, (fs, p) = spark._jvm, _open(spark, path)
    _, aside = _open(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    _write(fs.create(aside, False), text)
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
        rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(aside, p, rename)
    except Exception:
        fs.delete(aside, False)
        raise


def _by_create(spark: SparkSession, path: str, text: str) -> None:
    """Created in place; an object appears whole when its stream is closed, or not at all."""
    fs, p = _open(spark, path)
    make = fs.createFile(p).overwrite(False)
    if p.toUri().getScheme() not in CREATES_ATOMICALLY:
        if not fs.hasPathCapability(p, CONDITIONAL_CREATE):
            raise RuntimeError(f"{path}: this store can neither rename nor create without overwriting in one step, "
                               "so two writers could both commit; keep tables on one that can")
        make = make.must(CONDITIONAL_CREATE, "true")
    _write(make.build(), text)


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a new file in place whole, in one step that fails with ``FileExistsError`` if ``path``
    exists: of two writers of one path, one succeeds."""
    fs, p = _open(spark, path)
    fs.mkdirs(p.getParent())
    scheme = p.toUri().getScheme() or fs.getUri().getScheme()
    place = _by_link if scheme == "file" else _by_rename if scheme in RENAMES_ATOMICALLY else _by_create
    try:
        place(spark, path, text)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName() or fs.exists(p):
            raise FileExistsError(path) from e
        raise


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)

"""Small file operations of the driver on whatever file system a path names."""

import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Runs of one process take turns; runs of several rely on a rename that does not replace.
_TURN = threading.Lock()


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a pattern, in order; none where a folder is not there."""
    found = _system(spark, pattern).globStatus(_path(spark, pattern))
    return sorted(status.getPath().toString() for status in found or [])


def make_folder(spark: SparkSession, path: str) -> None:
    _system(spark, path).mkdirs(_path(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or folder; the target's folder is made, the target must not be there."""
    system = _system(spark, target)
    system.mkdirs(_path(spark, target).getParent())
    if not system.rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"cannot move {source} to {target}")


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Makes a file with all of ``text`` at once, unless it is there already: then False."""
    system, parent = _system(spark, path), _path(spark, path).getParent()
    system.mkdirs(parent)
    draft = _path(spark, f"{parent.toString()}/.draft-{uuid.uuid4().hex}")
    out = system.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    with _TURN:
        try:
            context.rename(system.makeQualified(draft), system.makeQualified(_path(spark, path)), no_options)
            return True
        except Py4JJavaError as error:
            system.delete(draft, False)
            if "FileAlreadyExistsException" in str(error.java_exception.getClass()):
                return False
            raise


def text_of(spark: SparkSession, path: str) -> str:
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()

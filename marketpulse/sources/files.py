"""Small files and listings through the path's own Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """File operations that work wherever Spark reads and writes."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def sizes(self, path: str, suffix: str = ".parquet") -> dict[str, int]:
        """Paths and sizes of the files of a folder (not of those below it)."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return {}
        return {s.getPath().toString(): s.getLen() for s in fs.listStatus(p)
                if s.isFile() and s.getPath().getName().endswith(suffix)}

    def read(self, path: str) -> str | None:
        """A small file's text; None if there is none."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Replaces a small file: written beside it, then renamed over it. Where a
        reader finds neither, ``path + ".new"`` is whole (see ``read_safe``)."""
        fs, new = self._at(path + ".new")
        stream = fs.create(new, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        _, old = self._at(path)
        fs.delete(old, False)
        fs.rename(new, old)

    def read_safe(self, path: str) -> str | None:
        """``read``, also after a crash in the middle of ``write``."""
        return self.read(path) or self.read(path + ".new")

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

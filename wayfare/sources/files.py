"""Small files and folders through Spark's file systems, so that any store Spark writes to will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Names, markers and short texts below a folder; never table data."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def names(self, folder: str = "") -> list[str]:
        """Sorted names in a folder; none if it does not exist."""
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(folder)))

    def folders(self, folder: str, depth: int) -> list[str]:
        """Folders ``depth`` levels below one, as paths relative to it."""
        found = [""]
        for _ in range(depth):
            found = [f"{f}/{n}".lstrip("/") for f in found for n in self.names(f"{folder}/{f}".rstrip("/"))
                     if not n.startswith(("_", "."))]
        return found

    def text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a new file; False, and nothing is written, if there is one of that name."""
        if self.exists(name):
            return False
        # The whole text is there before the name is.
        draft = f"{name}.{self._jvm.java.util.UUID.randomUUID().toString()}.draft"
        stream = self._fs.create(self._at(draft), False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        if not self.exists(name) and self._fs.rename(self._at(draft), self._at(name)):
            return True
        self.delete(draft)
        return False

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

"""Names and small text files of a table's folder, through the Hadoop file system that the path belongs to.

Used on the driver for metadata only: partition folder names and commit
markers.  No data file is opened here.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder on any file system that Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        raw = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = raw.getFileSystem(self._conf)
        self.path = self._fs.makeQualified(raw).toString().rstrip("/")

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """Names of what lies in the folder; none when it does not exist."""
        if not self.exists(name):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._at(name))]

    def partition_values(self, column: str) -> list[str]:
        """Values of a partition column, from the folder names alone."""
        head = f"{column}="
        return [n[len(head):] for n in self.names() if n.startswith(head)]

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """Create the file with its whole text, or leave it alone and say False when it is there already.

        The text is written under another name and then renamed without
        overwriting, so nobody sees half a file and of two writers one wins.
        """
        draft, final = self._at(f"_draft-{uuid.uuid4().hex}"), self._at(name)
        self._fs.mkdirs(final.getParent())
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 1)
        options[0] = rename.NONE
        try:
            context.rename(draft, final, options)
            return True
        except Py4JJavaError as e:
            self._fs.delete(draft, False)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise

    def delete(self, name: str) -> bool:
        return self._fs.delete(self._at(name), True)

    def modified(self, name: str) -> float:
        """Epoch seconds of the last change."""
        return self._fs.getFileStatus(self._at(name)).getModificationTime() / 1000

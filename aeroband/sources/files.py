"""The few file operations a snapshot needs, through the Hadoop file system that Spark itself uses, so that they
work on any store Spark can write to."""

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self.path = path.rstrip("/")
        self._hadoop_path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop_path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name=""):
        return self._hadoop_path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name="") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name="") -> list[str]:
        """Names of the entries of a sub-folder, sorted; none if it does not exist."""
        if not self.exists(name):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._at(name)))

    def seconds_since(self, name: str) -> float:
        """Age of a file by the clock of this machine."""
        now = self._jvm.java.lang.System.currentTimeMillis()
        return (now - self._fs.getFileStatus(self._at(name)).getModificationTime()) / 1000

    def mark(self, name: str) -> None:
        """Create an empty file; fails if it is there."""
        self._fs.create(self._at(name), False).close()

    def claim(self, name: str) -> bool:
        """Create an empty file, or say that it is there already."""
        try:
            self.mark(name)
        except Exception:  # stores differ in what they raise
            if self.exists(name):
                return False
            raise
        return True

    def write_text(self, name: str, text: str) -> None:
        """A new file; fails if it is there."""
        stream = self._fs.create(self._at(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

"""Files of the landing folder that the streaming file source never offers: names that begin with `_` or `.`.

The source passes over them in silence. Here the folder is listed for such names, those that the load log and the
offer folder do not hold yet are copied into the offer folder under a name that the source takes, and lineage gives
the first name back. The copies are made by the file system, piece by piece.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Names that Hadoop's and Spark's own writers leave beside data.
WRITERS_OWN = re.compile(r"_SUCCESS|_temporary|_spark_metadata|_metadata|_common_metadata|_started_.*|_committed_.*|\..*\.crc|.*\._COPYING_")
_HIDDEN = "[_.]"


@dataclass(frozen=True)
class Hidden:
    """A file with a hidden name: its path, its name below the landing folder, bytes and time of change."""

    path: str
    below: str
    size: int
    changed: int


class Ledger:
    """Offers hidden files of `landing` in `offered`, a folder of the same file system that the source reads as well."""

    def __init__(self, spark: SparkSession, landing: str, offered: str) -> None:
        self._spark, self._jvm = spark, spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._landing, self._offered = self._path(landing), self._path(offered)
        self._fs = self._landing.getFileSystem(self._conf)
        other = self._offered.getFileSystem(self._conf)
        same_system = str(self._fs.getUri()) == str(other.getUri())
        # A pattern of folders has no names below one folder; a folder that is not there is for the source to refuse.
        self.offers = same_system and not re.search(r"[*?\[{]", landing) and self._fs.exists(self._landing)
        self.landing, self.offered = (str(self._fs.makeQualified(path).toUri().getPath()) for path in (self._landing, self._offered))

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path(*parts)

    def source(self, landing: str) -> str:
        """One pattern for both folders; the landing folder alone if they are on different file systems or it is a pattern."""
        if not self.offers:
            return landing
        self._fs.mkdirs(self._offered)
        uri = self._fs.getUri()
        authority = f"//{uri.getAuthority()}" if uri.getAuthority() else ""
        return f"{uri.getScheme()}:{authority}/{{{self.landing[1:]},{self.offered[1:]}}}"

    # Names

    def _visible(self, below: str) -> str:
        """Put an `h` before hidden parts of a name, and before parts that look like such a one."""
        return "/".join(f"h{part}" if re.match(r"h*[_.]", part) else part for part in below.split("/"))

    def first_name(self, name: Column) -> Column:
        """The name a file had in the landing folder, from the one it was offered under."""
        at = F.locate(f"{self.offered}/", name)
        below = name.substr(at + len(self.offered) + 1, F.length(name))
        plain = F.regexp_replace(below, r"(^|/)h(h*[_.])", "$1$2")
        return F.when(at > 0, F.concat(name.substr(F.lit(1), at - 1), F.lit(f"{self.landing}/"), plain)).otherwise(name)

    # Files

    def hidden(self) -> list[Hidden]:
        """All files with a hidden part in their name, without those that writers leave. Plain names stay in the JVM."""
        found, depth = [], 0
        while True:
            level = self._path(str(self._landing), "/".join(["*"] * depth + [_HIDDEN + "*"]))
            for status in self._fs.globStatus(level) or []:
                if WRITERS_OWN.fullmatch(status.getPath().getName()):
                    continue
                files = self._fs.listFiles(status.getPath(), True)  # of a file: the file
                while files.hasNext():
                    one = files.next()
                    if not WRITERS_OWN.fullmatch(one.getPath().getName()):
                        path = one.getPath()
                        below = str(path.toUri().getPath())[len(self.landing) + 1 :]
                        found.append(Hidden(str(path), below, one.getLen(), one.getModificationTime()))
            depth += 1
            deeper = self._fs.globStatus(self._path(str(self._landing), "/".join(["*"] * depth + ["*"])))
            if deeper is None or len(deeper) == 0:
                break
        return sorted({one.below: one for one in found}.values(), key=lambda one: (one.changed, one.below))

    def listing(self) -> DataFrame:
        """Hidden files as a table: file_name as the load log has it, below, bytes."""
        scheme = "file://" if str(self._fs.getScheme()) == "file" else str(self._fs.getUri())
        rows = [(f"{scheme}{self.landing}/{one.below}", one.below, one.size) for one in self.hidden()]
        return self._spark.createDataFrame(rows, "file_name string, below string, bytes long")

    def offer(self, load_log: DataFrame) -> int:
        """Copy the hidden files that are not logged and not offered yet; the number of copies."""
        unseen = {row.below for row in self.listing().join(load_log, "file_name", "left_anti").select("below").collect()}
        copied = 0
        for one in self.hidden():
            target = self._path(str(self._offered), self._visible(one.below))
            if one.below not in unseen or self._fs.exists(target):
                continue
            aside = self._path(f"{target}._COPYING_")  # a name that the source does not take
            self._jvm.org.apache.hadoop.fs.FileUtil.copy(self._fs, self._path(one.path), self._fs, aside, False, True, self._conf)
            self._fs.setTimes(aside, one.changed, -1)
            self._fs.rename(aside, target)
            copied += 1
        return copied

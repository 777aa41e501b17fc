"""What has been extracted already: a ledger of archive files, and atomic commits to a lake.

A batch of files is written to hidden ``_staging`` folders of the lake and of the
ledger. It is committed by one small file in the ledger's ``_pending`` folder,
which lists the moves that bring the staged files to their places. A run that
ends before that file exists leaves nothing but staged files, which the next
run deletes; one that ends after it has committed, and the next run finishes
the moves (a staged file that is gone has been moved). So every batch is in
the lake and in the ledger either once or not at all. One run may write to a
ledger at a time. Folders are handled through Hadoop, so any store it knows will
do, if a rename there moves a file.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import delete_path

#: ``done``: read whole; ``damaged``: read but for gaps that stay however often it is read;
#: ``missing`` and ``failed`` (not readable): nothing of them is in the lake, the next run tries again.
STATUSES = ("done", "damaged", "missing", "failed")
SETTLED = ("done", "damaged")
LEDGER = T.StructType([
    T.StructField("batch", T.StringType()), T.StructField("warc_path", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("message", T.StringType()),
    *[T.StructField(c, T.LongType()) for c in ("extracted", "discarded", "errored", "total")]])
STAGING, PENDING = "_staging", "_pending"


class Ledger:
    def __init__(self, spark: SparkSession, url: str, lake: str):
        self.spark, self.url, self.lake = spark, url.rstrip("/"), lake.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    # -- reading
    def rows(self) -> DataFrame:
        """Every file of every committed batch; a file that was tried again has several rows."""
        found = self._exists(f"{self.url}/files")
        return self.spark.read.schema(LEDGER).parquet(f"{self.url}/files") if found else self.spark.createDataFrame([], LEDGER)

    def settled(self) -> DataFrame:
        """``warc_path`` of the files that no run need read again."""
        return self.rows().where(F.col("status").isin(*SETTLED)).select("warc_path").distinct()

    # -- a batch
    def begin(self) -> str:
        return uuid.uuid4().hex

    def staged_lake(self, batch: str) -> str:
        return f"{self.lake}/{STAGING}/{batch}"

    def staged_rows(self, batch: str) -> str:
        return f"{self.url}/{STAGING}/{batch}"

    def commit(self, batch: str) -> None:
        """Bring what is staged for ``batch`` into the lake and the ledger."""
        moves = [*self._moves(self.staged_lake(batch), self.lake), *self._moves(self.staged_rows(batch), f"{self.url}/files")]
        self._write(f"{self.url}/{PENDING}/{batch}.json", json.dumps(moves))
        self._finish(batch, moves)

    def recover(self) -> list[str]:
        """Finish committed batches and drop the others; the batches finished."""
        finished = []
        for path in self._files(f"{self.url}/{PENDING}"):
            if path.endswith(".json"):
                batch = path.rsplit("/", 1)[1].removesuffix(".json")
                text = self.spark.read.text(path, wholetext=True).first()["value"]
                self._finish(batch, json.loads(text))
                finished.append(batch)
        for root in (self.lake, self.url):
            delete_path(self.spark, f"{root}/{STAGING}")
        return finished

    # -- files
    def _path(self, url: str):
        return self.jvm.org.apache.hadoop.fs.Path(url)

    def _fs(self, url: str):
        return self._path(url).getFileSystem(self.conf)

    def _exists(self, url: str) -> bool:
        return self._fs(url).exists(self._path(url))

    def _files(self, url: str) -> list[str]:
        if not self._exists(url):
            return []
        found, out = self._fs(url).listFiles(self._path(url), True), []
        while found.hasNext():
            out.append(found.next().getPath().toString())
        return sorted(out)

    def _moves(self, staged: str, target: str) -> list[tuple[str, str]]:
        """Data files below ``staged`` with their places below ``target``; the names that
        Spark gives them are unique."""
        root = self._fs(staged).makeQualified(self._path(staged)).toString()
        return [(f, target + f[len(root):]) for f in self._files(staged) if f.rsplit("/", 1)[1].startswith("part-")]

    def _write(self, url: str, text: str) -> None:
        """A file that is there whole or not at all."""
        part = self._path(url + ".part")
        fs = self._fs(url)
        out = fs.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not fs.rename(part, self._path(url)):
            raise OSError(f"cannot write {url}")

    def _move(self, source: str, target: str) -> None:
        fs = self._fs(source)
        if fs.exists(self._path(source)):
            fs.mkdirs(self._path(target).getParent())
            if not fs.rename(self._path(source), self._path(target)):
                raise OSError(f"cannot move {source} to {target}")

    def _finish(self, batch: str, moves) -> None:
        for source, target in moves:
            self._move(source, target)
        for staged in (self.staged_lake(batch), self.staged_rows(batch)):
            delete_path(self.spark, staged)
        delete_path(self.spark, f"{self.url}/{PENDING}/{batch}.json")

"""A folder as a stream of file events.

Spark's own file stream knows a file by its path, so a name that is uploaded a
second time is never read again.  Here an event is (path, modification time,
length): a file that is replaced counts as a new one.  The offset of a batch is
the listing it has seen; the events of a batch are the entries of its listing
that the listing before lacks.  Files that are gone drop out of the offset, so
it stays as small as the folder (archive or delete what has been read).

The events carry no content: a batch's files are read by ``read_logs``, by the
names in their headers (``with_log_lines``).

The folder is listed by ``pyarrow.fs`` in the source's own Python process
(local and mounted paths, ``hdfs://``, ``s3://``, ``gs://``), with the
credentials of that process.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from logscan.schema import LOG_SCHEMA
from logscan.session import ship_package
from logscan.sources.logs import read_logs

FORMAT = "logscan_file_events"
EVENTS_DDL = "path string, modified timestamp, length long"


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def list_folder(folder: str, suffix: str = "") -> dict[str, tuple[int, int]]:
    """{path below the folder: (modification time in ns, length)} of its files;
    names that start with '.' or '_' are not files yet, as in Spark."""
    from pyarrow import fs

    system, root = _open(folder)
    out = {}
    for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        name = info.path[len(root.rstrip("/")) + 1:]
        hidden = any(part[:1] in "._" for part in name.split("/"))
        if info.type == fs.FileType.File and not hidden and name.endswith(suffix):
            out[name] = (int(info.mtime_ns or 0), int(info.size or 0))
    return out


def new_entries(before: dict, after: dict) -> list[tuple]:
    """(name, modified, length) in ``after`` that ``before`` lacks or holds otherwise."""
    return [(name, *after[name]) for name in sorted(after) if list(before.get(name, ())) != list(after[name])]


class _File(InputPartition):
    def __init__(self, files: list):
        super().__init__(None)
        self.files = files


class FolderReader(DataSourceStreamReader):
    def __init__(self, options):
        self.folder = options["path"].rstrip("/")
        self.suffix = options.get("suffix", "")
        self.archive = options.get("archive")

    def initialOffset(self) -> dict:  # noqa: N802 - names of the interface
        return {"files": {}}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"files": {k: list(v) for k, v in list_folder(self.folder, self.suffix).items()}}

    def partitions(self, start: dict, end: dict):
        return [_File(new_entries(start["files"], end["files"]))]

    def read(self, partition):
        for name, modified, length in partition.files:
            stamp = datetime.datetime.fromtimestamp(modified / 1e9, datetime.timezone.utc).replace(tzinfo=None)
            yield f"{self.folder}/{name}", stamp, length

    def commit(self, end: dict) -> None:
        """Archive what has been read; a file replaced since is still to be read
        and stays.  Names keep their modification time apart in the archive."""
        if not self.archive:
            return
        system, root = _open(self.folder)
        _, target = _open(self.archive)
        now = list_folder(self.folder, self.suffix)
        for name, seen in end["files"].items():
            if list(now.get(name, ())) == list(seen):
                to = f"{target.rstrip('/')}/{seen[0]}/{name}"
                system.create_dir(to.rpartition("/")[0], recursive=True)
                system.move(f"{root.rstrip('/')}/{name}", to)


class FileEvents(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return EVENTS_DDL

    def streamReader(self, schema):  # noqa: N802
        return FolderReader(self.options)


def stream_file_events(spark: SparkSession, folder: str, archive_dir: str | None = None, suffix: str = "") -> DataFrame:
    """A stream of (path, modified, length), one row for every file that lands
    in ``folder`` or is replaced there.  ``archive_dir`` (of the same file
    system, outside the folder) takes files whose batch is done."""
    if archive_dir and (archive_dir.rstrip("/") + "/").startswith(folder.rstrip("/") + "/"):
        raise ValueError("the archive folder must lie outside the watched folder")
    ship_package(spark)
    spark.dataSource.register(FileEvents)
    r = spark.readStream.format(FORMAT).option("suffix", suffix)
    return (r.option("archive", archive_dir) if archive_dir else r).load(folder)


def with_log_lines(write, schema=LOG_SCHEMA):
    """A foreachBatch function over file events: ``write(lines, batch_id)`` gets
    the log lines of the batch's files, bound by their headers.  The driver
    holds the paths of one batch.  A file that is gone before it was read
    fails the batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        files = [r["path"] for r in batch.select("path").collect()]
        if files:
            write(read_logs(batch.sparkSession, files, schema), batch_id)

    return run

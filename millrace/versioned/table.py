"""Tables with numbered versions on plain Parquet folders.

Layout below the table's path::

    commits/00000003.json   one line: version, time, operation, data folders,
                            and the files in them that were replaced
    data/<folder>/          Parquet files of one commit, never rewritten
    staged/<folder>/        data of a commit that is not made yet

A write prepares its folder under ``staged`` and then creates the next commit
file, which fails if another writer was first. That creation is the commit:
readers only look at commit files. The folder is renamed to ``data`` right
afterwards, by the writer or, if it died in between, by the next reader, so
``data`` holds committed rows only and can be followed as a file stream.

Needs a file system whose renames are atomic (HDFS and other hierarchical
stores). One writer wins per version; serializable isolation across several
concurrent readers-then-writers is not claimed beyond that.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.files import AlreadyThere, Files
from millrace.operators.keys import stored
from millrace.operators.quality import require_unique

_APPENDING = ("create", "append")
_HIT = "_source_row"


class CommitConflict(Exception):
    """Another writer committed first; nothing of this write is visible."""


class NoSuchVersion(LookupError):
    """The table has no version for the request."""


class NotAppendOnly(ValueError):
    """The table was changed in a way an append-only reader cannot follow."""


@dataclass(frozen=True)
class Commit:
    version: int
    timestamp_ms: int
    operation: str
    folders: list[str]
    added: list[str]
    schema: str
    # Last batch each streaming writer has committed.
    batches: dict[str, int] = field(default_factory=dict)
    # Files in ``folders`` whose rows were written again; their names are unique.
    dropped: list[str] = field(default_factory=list)

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


def _commit_name(version: int) -> str:
    return f"commits/{version:08d}.json"


# Fixed by the layout: the folder of a data file.
_FOLDER = "element_at(split(_metadata.file_path, '/'), -2)"


def _folder_of(file_path: str) -> Column:
    return F.element_at(F.split(file_path, "/"), -2)


def _milliseconds(moment: str | dt.date | dt.datetime) -> int:
    """A text or naive time is taken as UTC."""
    if isinstance(moment, str):
        moment = dt.datetime.fromisoformat(moment)
    if not isinstance(moment, dt.datetime):
        moment = dt.datetime.combine(moment, dt.time())
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    return (moment - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(milliseconds=1)


def _truth(condition: str | Column) -> Column:
    """A condition as a flag; NULL counts as false."""
    column = F.expr(condition) if isinstance(condition, str) else condition
    return F.coalesce(column, F.lit(False))


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._files = Files(spark, self.path)

    # ---- creating and reading -----------------------------------------------

    @classmethod
    def create(cls, df: DataFrame, path: str) -> VersionedTable:
        """Write a frame as version 0 of a new table."""
        table = cls(df.sparkSession, path)
        if table.exists():
            raise CommitConflict(f"{path} holds a table already")
        table._commit(None, "create", df)
        return table

    def exists(self) -> bool:
        return bool(self._files.names("commits"))

    def latest(self) -> Commit:
        """Newest commit, its data folders in place."""
        names = [n for n in self._files.names("commits") if n.endswith(".json")]
        if not names:
            raise NoSuchVersion(f"no table at {self.path}")
        commit = self._load(int(names[-1].removesuffix(".json")))
        self._settle(commit)
        return commit

    def commit_at(self, version: int | None = None, timestamp: str | dt.date | None = None) -> Commit:
        """Commit by number, or the last one not after a time; the newest by default."""
        if version is not None and timestamp is not None:
            raise ValueError("give a version or a timestamp, not both")
        newest = self.latest()
        if version is not None:
            if not 0 <= version <= newest.version:
                raise NoSuchVersion(f"version {version}, newest is {newest.version}")
            return self._load(version)
        if timestamp is None:
            return newest
        wanted = _milliseconds(timestamp)
        # Commit times rise with the version, so halve the range.
        low, high = 0, newest.version + 1
        while low < high:
            middle = (low + high) // 2
            if self._load(middle).timestamp_ms <= wanted:
                low = middle + 1
            else:
                high = middle
        if low == 0:
            raise NoSuchVersion(f"no version as early as {timestamp}")
        return self._load(low - 1)

    def read(self, version: int | None = None, timestamp: str | dt.date | None = None) -> DataFrame:
        commit = self.commit_at(version, timestamp)
        return self._rows(commit)

    def register(self, name: str) -> None:
        """Create or replace a view in the catalog that shows the newest version whenever it is used.

        The view is kept as text, so commits of other writers show as well. It
        reads replaced files too and drops their rows. Register again after an
        overwrite with another schema.
        """
        folder, data, commits = _FOLDER, f"parquet.`{self.path}/data/*`", f"json.`{self.path}/commits`"
        columns = ", ".join(f"`{c}`" for c in self.latest().struct.names)
        # max_by takes arrays along, so one small aggregate finds the newest commit.
        newest = f"SELECT max_by(folders, version) AS folders, max_by(dropped, version) AS dropped FROM {commits}"
        self.spark.sql(
            f"""CREATE OR REPLACE VIEW {name} AS
                WITH newest AS ({newest}), gone AS (SELECT explode(dropped) AS file FROM newest)
                SELECT {columns} FROM (SELECT *, {folder} AS _folder, _metadata.file_name AS _file FROM {data})
                WHERE _folder IN (SELECT explode(folders) FROM newest)
                  AND NOT EXISTS (SELECT 1 FROM gone WHERE gone.file = _file)"""
        )

    def history(self) -> DataFrame:
        """version, timestamp and operation of every commit."""
        self.latest()
        schema = "version BIGINT, timestamp_ms BIGINT, operation STRING"
        commits = self.spark.read.schema(schema).json(f"{self.path}/commits")
        return commits.select("version", F.timestamp_millis("timestamp_ms").alias("timestamp"), "operation")

    # ---- changing -------------------------------------------------------------

    def append(self, df: DataFrame, batch: tuple[str, int] | None = None, attempts: int = 20) -> Commit:
        """Add rows. ``batch=(writer, number)`` makes a repeated batch a no-op.

        An append does not depend on the rows already there, so after losing to
        another writer it is simply tried on the newer version.
        """
        base = self.latest()
        rows = self._aligned(df, base)
        staged = None
        for _ in range(attempts):
            if batch and batch[1] <= base.batches.get(batch[0], -1):
                if staged:
                    self._files.delete(f"staged/{staged}")
                return base
            staged = staged or self._stage("append", rows)
            try:
                kept = (base.folders, base.dropped)
                return self._publish(base, "append", staged, kept, base.schema, batch)
            except CommitConflict:
                base = self.latest()
        self._files.delete(f"staged/{staged}")
        raise CommitConflict(f"append to {self.path} lost {attempts} times")

    def overwrite(self, df: DataFrame, batch: tuple[str, int] | None = None) -> Commit:
        """Replace all rows, and the schema, by a frame."""
        base = self.latest()
        if batch and batch[1] <= base.batches.get(batch[0], -1):
            return base
        return self._commit(base, "overwrite", df, batch=batch)

    def update(self, condition: str | Column, assign: dict[str, str | Column]) -> Commit:
        """Set columns where a condition is true. Expressions see the old row.

        Only files that hold such a row are written again; without one there is
        no new version. The same goes for ``delete``.
        """
        base = self.latest()
        self._known(base, assign)
        hit = _truth(condition)
        touched = self._touched(base, lambda rows: rows.where(condition))
        if not touched:
            return base
        rows = self._rows(base, touched)
        values = []
        for f in base.struct.fields:
            if f.name in assign:
                new = assign[f.name]
                new = (F.expr(new) if isinstance(new, str) else new).cast(f.dataType)
                values.append(F.when(hit, new).otherwise(F.col(f.name)).alias(f.name))
            else:
                values.append(F.col(f.name))
        return self._commit(base, "update", rows.select(*values), touched)

    def delete(self, condition: str | Column) -> Commit:
        """Remove rows where a condition is true; NULL keeps the row."""
        base = self.latest()
        touched = self._touched(base, lambda rows: rows.where(condition))
        if not touched:
            return base
        return self._commit(base, "delete", self._rows(base, touched).where(~_truth(condition)), touched)

    def merge(
        self,
        source: DataFrame,
        key: list[str],
        update: dict[str, str] | None = None,
        delete_when: str | None = None,
        insert: bool = True,
    ) -> Commit:
        """Update, delete and insert by key in one commit.

        ``update`` maps columns to expressions over ``t`` (table) and ``s``
        (source); without it all columns of a matched row are taken from the
        source, NULLs included. Matched rows meeting ``delete_when`` go; source
        rows without a match are added. Without a row to change or add there is
        no new version. The source is evaluated once: one that does not come
        straight from files is written first. A key repeated in it is an error.
        """
        source = stored(source)
        base = self.latest()
        names = base.struct.names
        self._known(base, update or {})
        require_unique(source, key, "merge source")
        keys = source.select(*key).dropna()
        touched = self._touched(base, lambda rows: rows.join(keys, key, "left_semi"))

        matches = F.lit(True)
        for k in key:
            matches = matches & (F.col(f"t.{k}") == F.col(f"s.{k}"))
        marked = source.withColumn(_HIT, F.lit(True)).alias("s")
        # One source row at most per table row: a left join, so a key crowding
        # the table can be split over tasks.
        joined = self._rows(base, touched).alias("t").join(marked, matches, "left")
        hit = F.coalesce(F.col(_HIT), F.lit(False))
        if delete_when:
            joined = joined.where(~(hit & _truth(delete_when)))
        new = update if update is not None else {c: f"s.`{c}`" for c in names}
        changed = [
            F.when(hit, F.expr(new[f.name]).cast(f.dataType)).otherwise(F.col(f"t.{f.name}")).alias(f.name)
            if f.name in new
            else F.col(f"t.{f.name}")
            for f in base.struct.fields
        ]
        result = joined.select(*changed)
        if insert:
            # Files without a match cannot hold a source key.
            known = self._rows(base, touched).select(*key).distinct()
            missing = source.join(known, key, "left_anti")
            if not touched and missing.isEmpty():
                return base
            result = result.unionByName(self._aligned(missing.select(*names), base))
        elif not touched:
            return base
        return self._commit(base, "merge", result, touched)

    # ---- streaming ------------------------------------------------------------

    def read_stream(
        self, ignore_changes: bool = False, since: int | None = None, max_files: int | None = None
    ) -> DataFrame:
        """Streaming frame: the rows of version ``since`` (default: the newest),
        then those of each later commit.

        Rows a later update, delete, merge or overwrite has written again stop
        the query, or with ``ignore_changes`` are emitted again. A delete that
        leaves nothing to write again is not noticed. Give the same ``since``
        when restarting from a checkpoint.
        """
        start = self.commit_at(since)
        replaced = self._replaced_before(start)
        reader = self.spark.readStream.schema(start.struct)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        rows = reader.parquet(f"{self.path}/data/*")
        folder = _folder_of("_metadata.file_path")
        wanted = ~folder.isin(replaced) & ~F.col("_metadata.file_name").isin(start.dropped)
        if not ignore_changes:
            appended = folder.rlike(f"^({'|'.join(_APPENDING)})-") | folder.isin(start.folders)
            message = F.concat(F.lit("rows were rewritten after the stream began: "), folder)
            wanted = wanted & F.when(appended, True).otherwise(F.raise_error(message).cast("boolean"))
        return rows.where(wanted)

    def _replaced_before(self, commit: Commit) -> list[str]:
        """Folders written up to a commit that it does not contain any more."""
        if commit.operation in _APPENDING and commit.version == 0:
            return []
        written = (
            self.spark.read.schema("version BIGINT, added ARRAY<STRING>")
            .json(f"{self.path}/commits")
            .where(F.col("version") <= commit.version)
            .select(F.explode("added").alias("folder"))
        )
        current = set(commit.folders)
        return sorted(row.folder for row in written.collect() if row.folder not in current)

    # ---- inside ---------------------------------------------------------------

    def _load(self, version: int) -> Commit:
        return Commit(**json.loads(self._files.read_text(_commit_name(version))))

    def _settle(self, commit: Commit) -> None:
        """Finish a commit: move its folder from ``staged`` to ``data``."""
        for folder in commit.added:
            if not self._files.exists(f"data/{folder}"):
                self._files.make_folder("data")
                try:
                    self._files.move(f"staged/{folder}", f"data/{folder}")
                except Exception:
                    # Another reader may have finished it meanwhile.
                    if not self._files.exists(f"data/{folder}"):
                        raise

    def _rows(self, commit: Commit, files: list[tuple[str, str]] | None = None) -> DataFrame:
        """Rows of a version, or of some (folder, file) of it. Other files are pruned from the scan."""
        folders = commit.folders if files is None else sorted({folder for folder, _ in files})
        if not folders:
            return self.spark.createDataFrame([], commit.struct)
        rows = self.spark.read.schema(commit.struct).parquet(*[f"{self.path}/data/{f}" for f in folders])
        name = F.col("_metadata.file_name")
        if files is not None:
            return rows.where(name.isin([file for _, file in files]))
        return rows.where(~name.isin(commit.dropped)) if commit.dropped else rows

    def _touched(self, commit: Commit, pick) -> list[tuple[str, str]]:
        """(folder, file) of files holding rows the change applies to; the others are kept as they are.

        The driver sees names of files, never rows.
        """
        if not commit.folders:
            return []
        rows = self._rows(commit).withColumns({"_path": F.col("_metadata.file_path"), "_file": F.col("_metadata.file_name")})
        files = pick(rows).select(_folder_of("_path").alias("_folder"), "_file").distinct()
        return sorted((row["_folder"], row["_file"]) for row in files.collect())

    def _left(self, base: Commit | None, touched: list[tuple[str, str]] | None) -> tuple[list[str], list[str]]:
        """Folders and dropped files of a version without the touched files (None: without any row)."""
        if base is None or touched is None:
            return [], []
        dropped, folders = set(base.dropped) | {file for _, file in touched}, list(base.folders)
        for folder in {folder for folder, _ in touched}:
            files = set(self._files.names(f"data/{folder}"))
            if files <= dropped:
                folders.remove(folder)
                dropped -= files
        return folders, sorted(dropped)

    @staticmethod
    def _known(commit: Commit, assigned: dict) -> None:
        unknown = assigned.keys() - set(commit.struct.names)
        if unknown:
            raise ValueError(f"no such columns: {sorted(unknown)}")

    @staticmethod
    def _aligned(df: DataFrame, commit: Commit) -> DataFrame:
        """Columns in table order; other names or types are an error."""
        given = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        wanted = {f.name: f.dataType.simpleString() for f in commit.struct.fields}
        if given != wanted:
            raise ValueError(f"columns {df.schema.simpleString()} do not fit {commit.struct.simpleString()}")
        return df.select(*commit.struct.names)

    def _stage(self, operation: str, df: DataFrame) -> str:
        folder = f"{operation}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/staged/{folder}")
        return folder

    def _commit(
        self,
        base: Commit | None,
        operation: str,
        df: DataFrame,
        touched: list[tuple[str, str]] | None = None,
        batch: tuple[str, int] | None = None,
    ) -> Commit:
        schema = base.schema if base and operation != "overwrite" else _nullable(df.schema).json()
        staged = self._stage(operation, df)
        try:
            return self._publish(base, operation, staged, self._left(base, touched), schema, batch)
        except CommitConflict:
            self._files.delete(f"staged/{staged}")
            raise

    def _publish(self, base, operation, staged, kept, schema, batch) -> Commit:
        version = base.version + 1 if base else 0
        now = int(time.time() * 1000)
        commit = Commit(
            version=version,
            timestamp_ms=max(now, base.timestamp_ms + 1) if base else now,
            operation=operation,
            folders=[*kept[0], staged],
            added=[staged],
            schema=schema,
            batches={**(base.batches if base else {}), **(dict([batch]) if batch else {})},
            dropped=kept[1],
        )
        self._files.make_folder("commits")
        try:
            self._files.publish(_commit_name(version), json.dumps(asdict(commit)))
        except AlreadyThere as error:
            raise CommitConflict(f"version {version} of {self.path} was written by another writer") from error
        self._settle(commit)
        return commit


def _nullable(schema: StructType) -> StructType:
    return StructType([*[type(f)(f.name, f.dataType, True) for f in schema.fields]])

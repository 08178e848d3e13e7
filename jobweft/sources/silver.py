"""Silver tables as parquet.

Postings are rewritten board by board: a load writes a new version of the boards
it touched, names them in ``parts`` and then commits the version. Readers take the
newest committed version of each board, so a load that dies half-way leaves nothing
visible and old versions stay readable. The ledger keeps one version for the whole
table; errors and dimensions are added version by version. A version's name ends in
an id of its own, so a second attempt never writes into the folders of one that died,
nor two loads into each other's.

Commits are numbered. A commit is one small file named by its number; it is put in
place complete and only if no file of that name is there. So of two loads that
started from the same commit one comes second and is told so: its tables do not know
what the first one did, and it has to plan again.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweft.plans.seeds import DIMENSIONS
from jobweft.schemas import ERRORS, LEDGER, POSTINGS, ddl

_COMMITS = "number bigint, version string, committed_at string"
_PARTS = "table_name string, part string, version string"
_WHOLE = "*"


class CommitConflict(RuntimeError):
    """Another load committed since the tables were read."""


class SilverTables:
    """Tables below one root folder that all executors can reach.

    ``base`` pins them to what was committed up to that number.
    """

    def __init__(self, spark: SparkSession, root: str, base: int | None = None) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.base = base

    def snapshot(self) -> SilverTables:
        """The tables as they are now; later commits do not change them."""
        newest = self._committed().agg(F.max("number")).first()[0]
        return SilverTables(self.spark, self.root, newest or 0)

    def postings(self) -> DataFrame:
        return self._read_parts("postings", "source_key", ddl(POSTINGS))

    def links(self) -> DataFrame:
        linked = self.postings().where(F.col("canonical_id").isNotNull())
        return linked.select("posting_key", "canonical_id", "match_method", "matched_at")

    def canonicals(self) -> DataFrame:
        founders = self.postings().where(F.col("match_method") == "new_canonical_job")
        return founders.select("canonical_id", F.col("matched_at").alias("created_at"))

    def ledger(self) -> DataFrame:
        return self._read_whole("ledger", ddl(LEDGER))

    def errors(self) -> DataFrame:
        """Errors of all committed loads."""
        return self._read_all("errors", ddl(ERRORS))

    def dimensions(self) -> DataFrame:
        return self._read_all("dimensions", DIMENSIONS)

    def dimension(self, name: str) -> DataFrame:
        return self.dimensions().where(F.col("dimension") == name).drop("dimension")

    def quality_tables(self) -> dict[str, DataFrame]:
        postings = self.postings().select(
            "posting_key",
            F.col("company_name").alias("company"),
            F.col("content_fingerprint").alias("fingerprint"),
        )
        return {
            "ledger": self.ledger(),
            "postings": postings,
            "links": self.links(),
            "canonicals": self.canonicals(),
        }

    def next_version(self) -> str:
        """Name of a new version: above the one these tables are pinned to, and used by nobody else."""
        return f"{self._pinned() + 1:012d}-{uuid.uuid4().hex}"

    def write_postings(self, postings: DataFrame, version: str) -> None:
        """Write a new version of every board in ``postings``.

        The rebalance hint lets adaptive execution gather small boards in few files
        and split a board with a third of all rows over many tasks.
        """
        balanced = postings.withColumn("version", F.lit(version)).hint("rebalance", "source_key")
        (
            balanced.write.mode("append")
            .partitionBy("version", "source_key")
            .parquet(f"{self.root}/postings")
        )

    def write_whole(self, name: str, table: DataFrame, version: str) -> None:
        table.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version").parquet(
            f"{self.root}/{name}"
        )

    def write_errors(self, errors: DataFrame, version: str) -> None:
        self.write_whole("errors", errors, version)

    def commit(self, parts: DataFrame, version: str) -> None:
        """Make ``parts`` (table_name, part) of a version visible, all at once.

        Raises ``CommitConflict`` if another load committed after these tables were
        pinned; nothing of the version is visible then.
        """
        named = parts.withColumn("version", F.lit(version))
        named.coalesce(1).write.mode("append").parquet(f"{self.root}/parts")
        number = self._pinned() + 1
        row = {"number": number, "version": version, "committed_at": datetime.now(timezone.utc).isoformat()}
        if not _put_new(self.spark, f"{self.root}/commits", f"{number:012d}.json", json.dumps(row)):
            raise CommitConflict(f"commit {number} was made by another load")

    def _pinned(self) -> int:
        if self.base is None:
            raise ValueError("write to a snapshot of the tables")
        return self.base

    def _committed(self) -> DataFrame:
        commits = self._read_folder("commits", _COMMITS, "json")
        return commits if self.base is None else commits.where(F.col("number") <= self.base)

    def _commits(self) -> DataFrame:
        """Committed parts (table_name, part, version)."""
        return self._read_folder("parts", _PARTS).join(self._committed().select("version"), "version")

    def _read_all(self, name: str, schema: str) -> DataFrame:
        table = self._read_folder(name, f"{schema}, version string")
        committed = self._commits().where(F.col("table_name") == name).select("version").distinct()
        return table.join(committed, "version", "left_semi").drop("version")

    def _read_parts(self, name: str, part: str, schema: str) -> DataFrame:
        """Current parts of a table; the commit rows prune its folders at run time."""
        table = self._read_folder(name, f"{schema}, version string")
        current = (
            self._commits()
            .where(F.col("table_name") == name)
            .groupBy(F.col("part").alias(part))
            .agg(F.max("version").alias("version"))
        )
        return table.join(current, [part, "version"]).drop("version")

    def _read_whole(self, name: str, schema: str) -> DataFrame:
        table = self._read_folder(name, f"{schema}, version string")
        current = (
            self._commits().where(F.col("table_name") == name).agg(F.max("version").alias("version"))
        )
        return table.join(current, "version").drop("version")

    def _read_folder(self, name: str, schema: str, kind: str = "parquet") -> DataFrame:
        path = f"{self.root}/{name}"
        try:
            return self.spark.read.schema(schema).format(kind).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)


def whole(name: str, spark: SparkSession) -> DataFrame:
    """Commit row for a table that is rewritten as a whole."""
    return spark.createDataFrame([(name, _WHOLE)], "table_name string, part string")


def _put_new(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Write a small file whole, unless one of its name is there; tells whether it was written.

    The file is written under a name that readers skip and then renamed, which file
    systems such as HDFS refuse in one step if the new name is taken.
    """
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    conf = spark._jsc.hadoopConfiguration()
    files = path.getFileSystem(conf)
    files.mkdirs(path)
    draft = hadoop.Path(path, f"_{name}-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        hadoop.FileContext.getFileContext(path.toUri(), conf).rename(draft, hadoop.Path(path, name), options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        files.delete(draft, False)
        return False
    return True

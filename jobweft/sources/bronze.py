"""Bronze: complete board snapshots kept as they were received.

Two layouts hold the same rows. The file layout is one folder per run with
``response.json`` and ``metadata.json``; the table layout is parquet partitioned
by board and day. Both are read into one *runs* frame: a row per snapshot with
its payload as text.

A load reads them in two steps (``RunFiles``, ``RunTable``, ``RunFrame``): ``facts``
says which runs there are, without a payload, and ``with_payload`` reads the payloads
of those that are left to do. Payloads are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweft.functions import json_values as jv
from jobweft.functions.text import optional_text
from jobweft.functions.times import timestamp_error, timestamp_of

#: Columns of a runs frame.
RUN_COLUMNS = [
    "adapter_id", "source_id", "run_id", "raw_path", "retrieved_at", "record_count",
    "payload_sha256", "context_company", "context_source_key", "run_error", "payload",
]


#: The same without the payload.
FACT_COLUMNS = RUN_COLUMNS[:-1]


def paired_folders(paths: DataFrame, path: str = "path") -> DataFrame:
    """Folders (``run_dir``) that hold a metadata file and a response file.

    One aggregate over the folders of the wanted files; a path in a folder of its own
    or with another name counts for nothing.
    """
    name = F.element_at(F.split(path, "/"), -1)
    wanted = paths.select(_run_dir(F.col(path)), name.alias("_name"))
    both = F.bool_or(F.col("_name") == "metadata.json") & F.bool_or(F.col("_name") == "response.json")
    wanted = wanted.where(F.col("_name").isin("metadata.json", "response.json"))
    return wanted.groupBy("run_dir").agg(both.alias("_both")).where("_both").select("run_dir")


def discover_runs(spark: SparkSession, root: str) -> DataFrame:
    """Folders below ``root`` that hold a metadata file beside a response file."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "{metadata,response}.json")
        .load(root)
    )
    return paired_folders(files.select("path"))


@dataclass(frozen=True)
class RunFiles:
    """Runs of one adapter in the file layout."""

    spark: SparkSession
    root: str
    adapter_id: str

    def facts(self) -> DataFrame:
        """One row per complete run; bodies are listed, not read."""
        metadata = _texts(self.spark, self.root, "metadata.json", "metadata_text")
        complete = metadata.join(discover_runs(self.spark, self.root), "run_dir", "left_semi")
        return (
            parse_run_metadata(complete, F.col("metadata_text"))
            .withColumn("adapter_id", F.lit(self.adapter_id))
            .withColumnRenamed("run_dir", "raw_path")
            .select(FACT_COLUMNS)
        )

    def with_payload(self, todo: DataFrame) -> DataFrame:
        """``todo`` with payloads: exactly the files of these runs are opened.

        Their folders come to the driver; a load takes up a bounded number of runs
        at a time.
        """
        folders = [r.raw_path for r in todo.select("raw_path").distinct().collect()]
        if not folders:
            return todo.withColumn("payload", F.lit(None).cast("string"))
        bodies = folder_texts(self.spark, folders, "response.json", "payload")
        return bodies.join(F.broadcast(todo), bodies.run_dir == todo.raw_path).drop("run_dir")


@dataclass(frozen=True)
class RunTable:
    """Runs in the table layout; boards and days without a wanted run are not opened."""

    spark: SparkSession
    path: str

    def facts(self) -> DataFrame:
        return read_bronze(self.spark, self.path).select(FACT_COLUMNS)

    def with_payload(self, todo: DataFrame) -> DataFrame:
        """``todo`` with payloads; boards and days come to the driver, one for each run at most."""
        place = F.split("raw_path", "/")
        wanted = todo.withColumns(
            {"_board": F.try_element_at(place, F.lit(-3)), "_day": F.try_element_at(place, F.lit(-2))}
        )
        days = wanted.select("_board", "_day").distinct().collect()
        bodies = self.spark.read.parquet(self.path).where(
            F.col("source_key").isin([d._board for d in days])
            & F.col("ingest_date").cast("string").isin([d._day for d in days])
        )
        found = bodies.select(
            "adapter_id", F.col("source_key").alias("_board"), F.col("ingest_date").cast("string").alias("_day"),
            "run_id", F.col("payload").cast("string").alias("payload"),
        )
        met = found.join(F.broadcast(wanted), ["adapter_id", "_board", "_day", "run_id"])
        return met.select(*todo.columns, "payload")


@dataclass(frozen=True)
class RunFrame:
    """A runs frame that is there already."""

    frame: DataFrame

    def facts(self) -> DataFrame:
        return self.frame.select(FACT_COLUMNS)

    def with_payload(self, todo: DataFrame) -> DataFrame:
        keys = ["adapter_id", "source_id", "run_id", "raw_path"]
        bodies = self.frame.select(*[F.col(c).alias(f"_{c}") for c in keys], "payload")
        met = F.lit(True)
        for key in keys:
            met = met & (F.col(f"_{key}") == F.col(key))
        return bodies.join(F.broadcast(todo), met).select(*todo.columns, "payload")


def read_run_files(
    spark: SparkSession, root: str, adapter_id: str, done: DataFrame | None = None
) -> DataFrame:
    """The file layout as a runs frame; incomplete folders are left out.

    ``done`` (source_id, run_id) are runs to leave out before their payloads are
    joined, which keeps those out of every shuffle.
    """
    metadata = _texts(spark, root, "metadata.json", "metadata_text")
    payload = _texts(spark, root, "response.json", "payload")
    runs = parse_run_metadata(metadata, F.col("metadata_text"))
    if done is not None:
        runs = runs.join(done.select("source_id", "run_id"), ["source_id", "run_id"], "left_anti")
    return (
        runs.join(payload, "run_dir")
        .withColumn("adapter_id", F.lit(adapter_id))
        .withColumnRenamed("run_dir", "raw_path")
        .select(RUN_COLUMNS)
    )


def parse_run_metadata(df: DataFrame, text: Column) -> DataFrame:
    """Add the run fields read from metadata JSON; ``run_error`` tells what is wrong."""
    docs = df.withColumn("_doc", text)
    read = jv.with_members(
        docs, "_doc", "run_id", "source_id", "retrieved_at", "record_count", "payload_sha256",
        "context", prefix="meta_",
    )
    read = read.withColumn("_context", jv.Member("meta_context").object_text)
    read = jv.with_members(read, "_context", "company", "source_key", prefix="meta_")

    def member(name: str) -> jv.Member:
        return jv.Member(f"meta_{name}")

    at, count = member("retrieved_at"), member("record_count")
    read = read.select(
        *df.columns,
        jv.is_object(F.try_parse_json("_doc")).alias("_is_object"),
        optional_text(member("source_id").shown).alias("source_id"),
        optional_text(member("run_id").shown).alias("run_id"),
        timestamp_of(at.kind, at.shown).alias("retrieved_at"),
        F.coalesce(
            count.shown.try_cast("int"),
            F.when(count.kind != "STRING", count.shown.try_cast("double").try_cast("int")),
        ).alias("record_count"),
        optional_text(member("payload_sha256").shown).alias("payload_sha256"),
        member("company").shown.alias("context_company"),
        optional_text(member("source_key").shown).alias("context_source_key"),
        at.shown.alias("_at"),
        count.shown.alias("_count"),
    )
    problem = (
        F.when(~F.col("_is_object"), F.lit("Metadata must be a JSON object"))
        .when(F.col("run_id").isNull(), F.lit("Metadata field is missing: run_id"))
        .when(F.col("source_id").isNull(), F.lit("Metadata field is missing: source_id"))
        .when(
            F.col("_count").isNotNull() & F.col("record_count").isNull(),
            F.lit("Metadata field is no number: record_count"),
        )
        .otherwise(timestamp_error(F.col("retrieved_at"), F.col("_at")))
    )
    return read.withColumn("run_error", problem).drop("_is_object", "_at", "_count")


def record_count(payload: Column, *, bare_list: bool = False, members: tuple[str, ...] = ("jobs",)) -> Column:
    """Length of the job list of a payload, NULL when it has none.

    The first member that is a list counts, even an empty one; ``bare_list`` also
    accepts a list at the top.
    """
    shape = ", ".join(f"{m}: array<variant>" for m in members)
    doc = F.from_json(payload, f"struct<{shape}>")
    sizes = [F.size(doc[m]) for m in members]
    found = F.coalesce(*[F.when(doc[m].isNotNull(), n) for m, n in zip(members, sizes)])
    if bare_list:
        top = F.from_json(payload, "array<variant>")
        found = F.coalesce(F.when(top.isNotNull(), F.size(top)), found)
    return found


#: Counting rule per adapter.
RECORD_COUNT_RULES = {
    "greenhouse": {},
    "lever": {"bare_list": True, "members": ("data", "postings", "jobs")},
    "ashby": {},
}


#: What a request for a snapshot was and how it was answered; snapshots may come without.
REQUEST_COLUMNS = {
    "endpoint": "string", "method": "string", "request_params": "map<string,string>", "http_status": "int",
    "content_type": "string", "context": "map<string,string>",
}


def with_landing_columns(df: DataFrame, adapter_id: str) -> DataFrame:
    """Add run id, hash, size, count and day to rows of (source_key, company, payload).

    The request columns are kept where the rows have them, and null elsewhere; the
    context always names company and board.
    """
    body = F.col("payload").cast("binary")
    given = {c: F.col(c) if c in df.columns else F.lit(None) for c in REQUEST_COLUMNS}
    company = F.col("company") if "company" in df.columns else F.lit(None).cast("string")
    known = F.create_map(F.lit("company"), company, F.lit("source_key"), F.col("source_key"))
    more = F.coalesce(given["context"].cast(REQUEST_COLUMNS["context"]), F.create_map().cast(REQUEST_COLUMNS["context"]))
    others = F.map_filter(more, lambda k, _: ~k.isin("company", "source_key"))
    return (
        df.withColumns({c: column.cast(REQUEST_COLUMNS[c]) for c, column in given.items()})
        .withColumn("method", F.coalesce(F.upper("method"), F.lit("GET")))
        .withColumn("context", F.map_concat(known, others))
        .withColumn("adapter_id", F.lit(adapter_id))
        .withColumn("source_id", F.col("source_key"))
        .withColumn("run_id", F.replace(F.uuid(), F.lit("-"), F.lit("")))
        .withColumn("retrieved_at", F.current_timestamp())
        .withColumn("ingest_date", F.date_format("retrieved_at", "yyyy-MM-dd"))
        .withColumn("payload_sha256", F.sha2(body, 256))
        .withColumn("payload_size_bytes", F.octet_length(body).cast("bigint"))
        .withColumn(
            "record_count",
            record_count(F.col("payload").cast("string"), **RECORD_COUNT_RULES[adapter_id]),
        )
    )


def write_bronze(df: DataFrame, path: str, adapter_id: str) -> None:
    """Append snapshots (source_key, company, payload) to the table layout.

    Run ids are fresh, so an append never touches an earlier snapshot.
    """
    (
        with_landing_columns(df, adapter_id)
        .write.mode("append")
        .partitionBy("adapter_id", "source_key", "ingest_date")
        .parquet(path)
    )


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The table layout as a runs frame; filters on board and day prune folders."""
    return spark.read.parquet(path).select(
        "adapter_id",
        "source_id",
        "run_id",
        F.concat_ws("/", F.lit(path.rstrip("/")), "source_key", F.col("ingest_date").cast("string"), "run_id").alias("raw_path"),
        "retrieved_at",
        "record_count",
        "payload_sha256",
        F.col("company").alias("context_company"),
        F.col("source_key").alias("context_source_key"),
        F.lit(None).cast("string").alias("run_error"),
        F.col("payload").cast("string").alias("payload"),
    )


def _texts(spark: SparkSession, root: str | list[str], name: str, column: str) -> DataFrame:
    files = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name)
        .text(root, wholetext=True)
    )
    return files.select(_run_dir(F.col("_metadata.file_path")), F.col("value").alias(column))


def folder_texts(spark: SparkSession, folders: list[str], name: str, column: str) -> DataFrame:
    """Texts of one file of each folder, ``(run_dir, column)``; no folders give no rows."""
    if not folders:
        return spark.createDataFrame([], f"run_dir string, {column} string")
    return _texts(spark, folders, name, column)


def _run_dir(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]+$", "").alias("run_dir")

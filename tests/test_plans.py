"""Shapes of physical plans that matter at scale."""

import io
import uuid
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from jobweft.catalog import registered
from jobweft.plans.quality import Check, check_results, count_mismatches, run_checks
from jobweft.operators.ordering import run_order, with_ordinal
from jobweft.operators.upsert import child_delta, upsert
from jobweft.sources.silver import CommitConflict, SilverTables


def plan(frame):
    out = io.StringIO()
    with redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


def test_no_cross_join_and_no_single_partition_window(spark, sf_dir):
    for name, query in registered().items():
        if name.startswith(("canonical_a", "canonical_e", "silver_reports")):
            continue  # they run jobs while they are built
        text = plan(query(spark, sf_dir))
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_scans_are_pruned_and_filters_pushed(spark, sf_dir):
    text = plan(contract.queries()["report_count_left_unknown"](spark, sf_dir))
    assert "EqualTo(l_linestatus,O)" in text
    assert "GreaterThan(s_acctbal,5000" in text
    assert "ReadSchema: struct<l_suppkey:bigint,l_linestatus:string>" in text


def test_facts_are_counted_before_they_meet_a_dimension(spark, sf_dir):
    text = plan(contract.queries()["report_count_left_unknown"](spark, sf_dir))
    assert text.index("HashAggregate") < text.index("Join")


def test_error_summaries_are_limited_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan(contract.queries()["run_outcome"](spark, sf_dir))


def test_matching_needs_no_shuffle_and_no_python(spark, tmp_path):
    from jobweft.catalog.inputs import TERMS
    from jobweft.operators.dictionary import key_tokens

    docs = spark.range(10).select("id", F.lit("the text").alias("text"))
    docs.write.parquet(str(tmp_path / "docs"))
    read = spark.read.parquet(str(tmp_path / "docs")).withColumn("k", key_tokens("text", [TERMS]))
    text = plan(read.select("id", TERMS.find_all("text", "k")))
    assert "Exchange" not in text and "Python" not in text


def test_commits_hide_unfinished_versions_and_prune_folders(spark, tmp_path):
    tables = SilverTables(spark, str(tmp_path / "silver"))
    assert tables.postings().count() == 0
    empty = tables.postings()
    fields = {c: F.lit(None).cast(t) for c, t in empty.dtypes}

    def rows(board, job):
        known = {"source_key": F.lit(board), "posting_key": F.lit(f"{board}/{job}")}
        return spark.range(1).select(*[known.get(c, v).alias(c) for c, v in fields.items()])

    def commit(board, version):
        parts = spark.createDataFrame([("postings", board)], "table_name string, part string")
        tables.snapshot().commit(parts, version)

    first = tables.snapshot().next_version()
    # Dies before its commit.
    tables.write_postings(rows("a", 9).unionByName(rows("b", 9)), tables.snapshot().next_version())
    tables.write_postings(rows("a", 1).unionByName(rows("b", 1)), first)
    assert tables.postings().count() == 0
    commit("a", first)
    commit("b", first)
    pinned = tables.snapshot()
    second = pinned.next_version()
    tables.write_postings(rows("a", 2), second)
    assert sorted(r.posting_key for r in tables.postings().collect()) == ["a/1", "b/1"]
    commit("a", second)
    assert sorted(r.posting_key for r in tables.postings().collect()) == ["a/2", "b/1"]
    assert sorted(r.posting_key for r in pinned.postings().collect()) == ["a/1", "b/1"]
    newest = tables.snapshot()
    assert newest.next_version().startswith("000000000004-") and newest.next_version() != newest.next_version()
    # A commit from tables that are no longer the newest is refused and leaves nothing.
    late = pinned.next_version()
    tables.write_postings(rows("b", 3), late)
    with pytest.raises(CommitConflict):
        pinned.commit(spark.createDataFrame([("postings", "b")], "table_name string, part string"), late)
    assert sorted(r.posting_key for r in tables.postings().collect()) == ["a/2", "b/1"]
    with pytest.raises(ValueError, match="snapshot"):
        tables.next_version()


def test_check_runner(spark):
    ledger = spark.createDataFrame(
        [("s", "r", "processed", 3, 2)],
        "source_id string, run_id string, status string, record_count int, processed_records int",
    )
    checks = {
        "b_fails": Check(report=lambda t: t["ledger"], violations=lambda t: t["ledger"]),
        "a_broken": Check(report=lambda t: t["nowhere"]),
        "c_fine": Check(report=lambda t: t["ledger"]),
    }
    rows = run_checks(spark, {"ledger": ledger}, checks).collect()
    assert [(r.check, r.passed) for r in rows] == [("a_broken", False), ("b_fails", False), ("c_fine", True)]
    with pytest.raises(RuntimeError, match="a_broken, b_fails"):
        run_checks(spark, {"ledger": ledger}, checks, strict=True)
    with pytest.raises(RuntimeError, match="No quality checks found"):
        run_checks(spark, {}, {})


def test_ordinals_are_gapless_and_sorted_by_ranges(spark):
    rows = spark.range(5000).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 3 > 0, "hot").alias("v"))
    numbered = with_ordinal(rows, ["k", "v"])
    text = plan(numbered)
    assert "SinglePartition" not in text
    got = [(r.k, r.v or "") for r in numbered.orderBy("ordinal").collect()]
    assert got == sorted(got) and sorted(r.ordinal for r in numbered.collect()) == list(range(5000))
    assert with_ordinal(rows.limit(0), ["k"]).count() == 0


def test_runs_of_unknown_sources_come_last(spark):
    runs = spark.createDataFrame([("b", "1"), ("x", "0"), ("a", "2"), ("a", "1"), (None, "9")], "adapter_id string, raw_path string")
    sources = spark.createDataFrame([("b", 0), ("a", 1)], "adapter_id string, source_ord int")
    rows = run_order(runs, sources).orderBy("ordinal").collect()
    assert [(r.adapter_id, r.raw_path) for r in rows] == [("b", "1"), ("a", "1"), ("a", "2"), (None, "9"), ("x", "0")]


def test_checks_return_their_rows_and_are_read_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        reads.add(1)
        yield from batches

    ledger = spark.createDataFrame(
        [("s", "r", "processed", 3, 2), ("s", "t", "failed", None, 0)],
        "source_id string, run_id string, status string, record_count int, processed_records int",
    ).coalesce(1)
    checks = {
        "a": Check(report=lambda t: t["ledger"].mapInArrow(seen, t["ledger"].schema).select("run_id")),
        "b": Check(report=lambda t: t["ledger"].select("status"), violations=lambda t: count_mismatches(t["ledger"])),
        "c": Check(report=lambda t: t["ledger"].select(F.raise_error(F.lit("broken")).alias("x"))),
    }
    summary, rows = check_results(spark, {"ledger": ledger}, checks)
    assert [(r.check, r.passed, r.violations) for r in summary.collect()] == [("a", True, 0), ("b", False, 1), ("c", False, None)]
    found = sorted((r.check, r.kind, r.row) for r in rows.collect())
    assert found[:2] == [("a", "report", '{"run_id":"r"}'), ("a", "report", '{"run_id":"t"}')]
    assert [f[:2] for f in found[2:]] == [("b", "report")] * 2 + [("b", "violation")]
    assert reads.value == 1


def test_upsert_shuffles_no_bucketed_state_and_sorts_no_payload_aggregate(spark):
    rows = spark.range(3000).select(
        (F.col("id") % 1000).alias("k"), F.col("id").alias("at"), F.col("id").alias("made"), F.concat(F.lit("body "), "id").alias("body"),
        F.array(F.col("id") % 3, F.col("id") % 5).alias("kids"),
    )
    name = f"state_{uuid.uuid4().hex}"
    rows.where("id < 1000").write.bucketBy(8, "k").sortBy("k").saveAsTable(name)
    try:
        state, batch = spark.table(name), rows.where("id >= 1000")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = upsert(state, batch, ["k"], ["at"], ["made"])
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in text
        above, depth = [], None
        for line in reversed(text.splitlines()):
            column = len(line) - len(line.lstrip(" :+-"))
            if depth is None and name in line:
                depth = column
            elif depth is not None and column < depth:
                above.append(line.strip(" :+-"))
                depth = column
        until = next(i for i, line in enumerate(above) if line.startswith("SortMergeJoin"))
        assert not any(line.startswith("Exchange") for line in above[:until])
        got = {r.k: (r.at, r.made, r.body) for r in found.collect()}
        assert got == {k: (2000 + k, k, f"body {2000 + k}") for k in range(1000)}
        delta = child_delta(state, batch, ["k"], ["at"], "kids").collect()
        want = set()
        for k in range(1000):
            old, new = ({i % 3, i % 5} for i in (k, 2000 + k))
            want |= {(k, c, "delete") for c in old - new} | {(k, c, "insert") for c in new - old}
        assert {tuple(r) for r in delta} == want and len(delta) == len(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE {name}")


def test_upsert_of_late_equal_and_null_rows(spark):
    kind = "k string, at int, made int, v string"
    state = spark.createDataFrame([("a", 5, 1, "a5"), ("b", 5, 1, "b5"), ("c", None, 1, "c")], kind)
    batch = spark.createDataFrame(
        [("a", 4, 9, "a4"), ("b", 5, 9, "new b5"), ("c", 1, 0, "c1"), ("d", 1, 8, "d1"), ("d", 2, 9, "d2"), ("d", None, None, "d")], kind
    )
    got = {r.k: (r.at, r.made, r.v) for r in upsert(state, batch, ["k"], ["at"], ["made"]).collect()}
    assert got == {"a": (5, 1, "a5"), "b": (5, 1, "new b5"), "c": (1, 0, "c1"), "d": (2, 8, "d2")}
    assert upsert(state, batch.limit(0), ["k"], ["at"], ["made"]).count() == 3
    assert upsert(state.limit(0), batch, ["k"], ["at"], []).count() == 4


def test_postings_are_parsed_before_their_errors_are_filtered(spark, tmp_path, monkeypatch):
    from jobweft.catalog import adapters

    rows = [(1, "title\nthe text " * 20, "en", "src0", 301), (2, "der Text", "de", "src1", 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    monkeypatch.setattr(adapters, "cut_lineage", lambda df: kept.append(df) or df)
    adapters.silver_reports(spark, str(tmp_path))
    assert kept[0]._jdf.queryExecution().optimizedPlan().toString().count("from_json") < 200

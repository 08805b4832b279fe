"""Plan shape: shuffles, broadcasts and pushdown of the main jobs."""

import pytest

import __spark_entry__ as E
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL
from trawl.operators import entities, stats
from trawl.operators.snapshot import to_snapshots
from trawl.plans import jobs
from trawl.plans.queries import QUERIES
from trawl.sources import fixtures as fx
from trawl.sources import sinks
from trawl.sources.webarchive import read_archive, write_archive

# these write their input or output while the plan is built
WRITES_FIRST = {"warc_roundtrip", "warc_split_exact", "warc_whole_gzip", "warc_corrupt", "arc_split_exact", "quarantine",
                "doc_project", "doc_upsert", "json_lines", "text_export", "domain_list_scan", "pub_date_list"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


@pytest.fixture(scope="module")
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_cross_or_nested_loop_joins(no_aqe):
    for name, q in E.queries().items():
        if name not in QUERIES or name in WRITES_FIRST:
            continue  # covered by the oracle test
        p = plan(q(no_aqe, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
        assert "BatchEvalPython" not in p, name  # no row-at-a-time Python UDFs


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "a")
    return write_archive(fx.capture_records(spark, SF_SMALL).drop("page_id"), path)


def nodes(df, name):
    """The output column names of all nodes of a kind in the physical plan."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]  # noqa: SLF001
    while todo:
        n = todo.pop()
        if n.nodeName() == name:
            out = n.output()
            found.append({out.apply(i).name() for i in range(out.size())})
        todo += [n.children().apply(i) for i in range(n.children().size())]
    return found


@pytest.fixture
def no_broadcast(no_aqe):
    no_aqe.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield no_aqe
    no_aqe.conf.unset("spark.sql.autoBroadcastJoinThreshold")


GAZ = "spot string, title string, rho double"


def annotated(spark):
    docs = spark.createDataFrame([("a", "<p>x</p>", "some words"), (None, "y", "some words")], "id string, html string, article string")
    gaz = spark.createDataFrame([("some words", "T", 0.9), ("some", "S", 0.9), ("words", "W", 0.1)], GAZ)
    return entities.with_entities(docs, gaz, "id")


def test_pages_never_meet_the_gazetteer(no_broadcast):
    """Without broadcasts the joins by token and by n-gram move narrow rows with no NULL key; the page joins by id alone."""
    df = annotated(no_broadcast)
    p = plan(df)
    assert {r["html"]: r["entities"] for r in df.collect()} == {"<p>x</p>": "spot: some words title: T\n", "y": ""}
    lines = p.splitlines()
    by_word = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(token" in line or "Exchange hashpartitioning(_gram" in line]
    assert len(by_word) == 3 and "Exchange hashpartitioning(first" in p and "Broadcast" not in p
    assert all("html" not in lines[i + 1] for i in by_word)
    # the hits move once, and the line of a document is made where its mentions are
    assert p.count("Exchange hashpartitioning(id") == 2 and "LeftOuter" in p


def test_only_the_gazetteer_is_broadcast(no_aqe):
    """Whatever Spark makes of the size of exploded n-grams, they are never the built side."""
    docs = no_aqe.range(10).select(F.col("id"), F.lit("some words").alias("article"))
    gaz = no_aqe.range(100_000).select(F.concat(F.lit("some w"), "id").alias("spot"), F.col("id").cast("string").alias("title"), F.lit(0.9).alias("rho"))
    for limit in ("10m", "200k"):  # the spots are under the first, over the second
        no_aqe.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            df = entities.entity_mentions(docs, gaz, "id")
            built = nodes(df, "BroadcastExchange")
        finally:
            no_aqe.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert not any("id" in cols or "pos" in cols for cols in built)
        assert ("SortMergeJoin" in plan(df)) == (limit == "200k")


def test_longer_ngrams_only_where_a_spot_can_begin(no_aqe):
    """Rows into the join by n-gram: at most one for each length of the spots that begin with a token that occurs."""
    docs = no_aqe.range(50).select(F.col("id"), F.lit("the old town of the north " * 20).alias("article"))
    gaz = no_aqe.createDataFrame([("old town of", "O", 0.9), ("north sea", "N", 0.9), ("old", "o", 0.4), ("absent long spot of five", "A", 0.9)], GAZ)
    df = entities.entity_mentions(docs, gaz, "id")
    got = df.groupBy("spot").count().collect()
    assert {r["spot"]: r["count"] for r in got} == {"old town of": 1000}
    tries = [c for c in nodes(df, "Generate") if {"n", "_next"} <= c]
    assert len(tries) == 1  # exploded from the lengths that the index holds for the token


def test_html_moves_once(no_broadcast, monkeypatch):
    """Documents are bucketed by id in the keep-latest's shuffle; entity strings and hints come to them."""
    from trawl.session import Workspace
    written = []
    real = Workspace.bucketed
    monkeypatch.setattr(Workspace, "bucketed", lambda self, df, *a: written.append(df) or real(self, df, *a))
    with Workspace(no_broadcast) as ws:
        docs = jobs.documents(fx.capture_records(no_broadcast, SF_SMALL), fx.gazetteer(no_broadcast, SF_SMALL),
                              hints=fx.domain_hints(no_broadcast, SF_SMALL), ws=ws)
        moved = [c for df in (*written, docs) for c in nodes(df, "Exchange") if "html" in c]
        assert len(moved) == 1
        assert docs.count() > 0 and docs.where("pub_date is null").count() == 0


def test_a_workspace_leaves_nothing(spark, tmp_path):
    import os

    from trawl.session import Workspace, shared_dir
    base = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    with Workspace(spark) as ws:
        jobs.documents(fx.capture_records(spark, SF_SMALL), fx.gazetteer(spark, SF_SMALL), ws=ws).count()
        assert set(os.listdir(base)) > before
    assert set(os.listdir(base)) == before and not [t for t in spark.catalog.listTables() if t.name.startswith("documents_")]


def test_documents_without_a_workspace_leave_no_table(spark):
    before = {t.name for t in spark.catalog.listTables()}
    docs = jobs.documents(fx.capture_records(spark, SF_SMALL), fx.gazetteer(spark, SF_SMALL))
    assert {t.name for t in spark.catalog.listTables()} == before
    assert docs.count() > 0 and docs.where("id is null").isEmpty()  # its files are still read


def test_an_application_leaves_nothing(tmp_path):
    """A workspace that nobody closes goes when the application ends."""
    import subprocess
    import sys
    code = ("from pyspark.sql import SparkSession; from trawl.session import Workspace;"
            f"s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').config('spark.checkpoint.dir', 'file://{tmp_path}').getOrCreate();"
            "print(Workspace(s).written(s.range(3), 't').count())")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "3" and not [p for p in tmp_path.rglob("work-*")]


def test_one_scan_for_audit_and_upsert(no_aqe, archive, tmp_path):
    audit = stats.scan_audit(to_snapshots(read_archive(no_aqe, archive)))
    assert plan(audit).count("BatchScan") == 1
    counts = jobs.documents(read_archive(no_aqe, archive), fx.gazetteer(no_aqe, SF_SMALL))
    assert "BatchScan" not in plan(counts)  # the written documents are read, not the archive
    seen = []
    real = sinks.keep_latest
    sinks.keep_latest = lambda *a: seen.append(real(*a)) or seen[-1]
    try:
        rows = jobs.extracted(jobs.ok_captures(read_archive(no_aqe, archive))).select("id", "url", "wc")
        old = sinks.upsert_documents(no_aqe, rows, str(tmp_path / "a"), order=())
        sinks.upsert_documents(no_aqe, rows, str(tmp_path / "b"), existing_path=old, order=())
    finally:
        sinks.keep_latest = real
    assert all(plan(x).count("BatchScan") == 1 for x in seen)


def test_text_job_filters_by_a_semi_join(no_aqe):
    p = plan(E.queries()["text_rows"](no_aqe, SF_SMALL))
    assert "LeftSemi" in p and "row_number" not in p
    assert "row_number(), 10, Partial" in plan(E.queries()["cap_per_file"](no_aqe, SF_SMALL))


def test_link_count_is_two_level(no_aqe):
    p = plan(E.queries()["distinct_links"](no_aqe, SF_SMALL))
    assert "hashpartitioning(link" in p and "partial_count" in p

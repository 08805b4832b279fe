"""The two jobs from the command line, on an archive of the sf0.001 pages."""

from trawl.plans import cli
from trawl.sources import fixtures as fx
from trawl.sources.webarchive import write_archive
from tests.conftest import SF_SMALL


def test_index_and_text_jobs(spark, tmp_path):
    arch, gaz, lists = str(tmp_path / "arch"), str(tmp_path / "gaz"), str(tmp_path / "lists")
    write_archive(fx.capture_records(spark, SF_SMALL).drop("page_id"), arch)
    fx.gazetteer(spark, SF_SMALL).write.parquet(gaz)
    fx.domains(spark, SF_SMALL).write.text(lists)

    cli.main(["index", "--input", arch, "--gazetteer", gaz, "--output", str(tmp_path / "docs")])
    docs = spark.read.parquet(str(tmp_path / "docs"))
    expected = fx.capture_records(spark, SF_SMALL)
    from trawl.plans import jobs
    want = jobs.documents(expected, fx.gazetteer(spark, SF_SMALL))
    assert sorted(r["id"] for r in docs.select("id").collect()) == sorted(r["id"] for r in want.select("id").collect())

    cli.main(["index", "--input", arch, "--gazetteer", gaz, "--output", str(tmp_path / "docs2"),
              "--existing", str(tmp_path / "docs")])
    assert spark.read.parquet(str(tmp_path / "docs2")).count() == docs.count()
    for _ in range(2):  # in place, and again
        cli.main(["index", "--input", arch, "--gazetteer", gaz, "--output", str(tmp_path / "table"), "--upsert"])
        assert spark.read.parquet(str(tmp_path / "table")).drop("_bucket").exceptAll(docs).isEmpty()

    cli.main(["text", "--input", arch, "--domains", lists, "--output", str(tmp_path / "text"), "--files", "2"])
    lines = spark.read.text(str(tmp_path / "text")).count()
    assert lines > 0
    cli.main(["text", "--input", arch, "--domains", lists, "--output", str(tmp_path / "rows"), "--format", "parquet"])
    rows = spark.read.parquet(str(tmp_path / "rows"))
    assert 0 < rows.count() < lines and rows.where("value like '%\n%'").count() == rows.count()

    # the audit counts every record of the scan, whatever dropped it; the fixture has no reader errors
    audit = {r["reason"]: r["n"] for r in spark.read.json(str(tmp_path / "docs_audit")).collect()}
    from trawl.operators import stats
    from trawl.operators.snapshot import to_snapshots
    from trawl.sources.webarchive import read_archive
    want = {r["reason"]: r["n"] for r in stats.scan_audit(to_snapshots(read_archive(spark, arch))).collect()}
    assert {k: v for k, v in audit.items() if v and k != "Quarantined"} == {k: v for k, v in want.items() if v}
    assert audit["Quarantined"] == spark.read.json(str(tmp_path / "docs_quarantine")).count() > 0


def test_damaged_members_reach_the_quarantine(spark, tmp_path):
    arch = fx.odd_archive(spark, SF_SMALL, str(tmp_path / "odd"), "corrupt")
    lists = str(tmp_path / "lists")
    fx.domains(spark, SF_SMALL).write.text(lists)
    cli.main(["text", "--input", arch, "--domains", lists, "--output", str(tmp_path / "t"), "--per-file", "3", "--max-failed", "0.2"])
    bad = spark.read.json(str(tmp_path / "t_quarantine"))
    assert bad.where("quarantine_reason like 'corrupt gzip member%'").count() == 5


def test_nothing_is_published_over_the_failure_budget(spark, tmp_path):
    """A tenth of the members is corrupt: published at 0.2; at 0.05 the old result stays, with audit and quarantine written."""
    import pytest

    from trawl.sources.sinks import FailureBudgetExceeded
    arch, lists, gaz = fx.odd_archive(spark, SF_SMALL, str(tmp_path / "odd"), "corrupt"), str(tmp_path / "lists"), str(tmp_path / "gaz")
    fx.domains(spark, SF_SMALL).write.text(lists)
    fx.gazetteer(spark, SF_SMALL).write.parquet(gaz)
    text = ["text", "--input", arch, "--domains", lists, "--format", "parquet", "--output", str(tmp_path / "t")]
    index = ["index", "--input", arch, "--gazetteer", gaz, "--output", str(tmp_path / "d")]
    for job, out in ((text, "t"), (index, "d"), ([*index[:-1], str(tmp_path / "u"), "--upsert"], "u")):
        with pytest.raises(FailureBudgetExceeded):
            cli.main(job)
        assert not (tmp_path / out).exists()
        assert spark.read.json(str(tmp_path / f"{out}_quarantine")).where("quarantine_reason like 'corrupt%'").count() == 5
        cli.main([*job, "--max-failed", "0.2"])
        files = sorted(p.name for p in (tmp_path / out).rglob("*.parquet"))
        assert files and spark.read.parquet(str(tmp_path / out)).count() > 0
        with pytest.raises(FailureBudgetExceeded):
            cli.main([*job, "--max-failed", "0.05"])
        assert sorted(p.name for p in (tmp_path / out).rglob("*.parquet")) == files
    assert not [p for p in tmp_path.iterdir() if "__" in p.name]

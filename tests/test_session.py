from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from tillstone.plans import job, overlays, session

JOB = """
import sys
from pathlib import Path
from tillstone.plans.registry import QUERIES
from tillstone.plans.session import FOLDER_SETTING, discard_settled, local_session, run_folder
spark = local_session("4", "bare", folder=sys.argv[1])
assert spark.conf.get("spark.checkpoint.dir", None) is None and spark.conf.get(FOLDER_SETTING) == sys.argv[1]
for name in ("flatten_titles", "land_pages", "publish_replace"):
    assert QUERIES[name].spark(spark, "/root/testdata/sf0.001").count()
assert run_folder(spark).startswith(sys.argv[1]) and any(Path(run_folder(spark)).iterdir())
discard_settled(spark)
assert not Path(run_folder(spark)).exists()
"""


def test_a_job_needs_no_more_than_the_folder_it_is_given(tmp_path):
    """Without any settings of the machine: the same as on a cluster that names no folder."""
    (tmp_path / "conf").mkdir()
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    run = subprocess.run(
        [sys.executable, "-c", JOB, str(tmp_path / "settled")], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=240
    )
    assert run.returncode == 0, run.stderr[-3000:]


def stub(master: str, **settings):
    context = SimpleNamespace(master=master, applicationId="app")
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: settings.get(name, default)), sparkContext=context)


@pytest.mark.parametrize("master", ["yarn", "spark://m:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_refused(master):
    with pytest.raises(RuntimeError, match="shared by all executors"):
        session.shared_folder(stub(master))
    assert session.run_folder(stub(master, **{"spark.checkpoint.dir": "hdfs://a/b/"})) == "hdfs://a/b/app"
    assert session.shared_folder(stub(master, **{session.FOLDER_SETTING: "s3a://c"})) == "s3a://c"


def test_the_clusters_own_setting_wins():
    both = {"spark.checkpoint.dir": "hdfs://a", session.FOLDER_SETTING: "s3a://c"}
    assert session.shared_folder(stub("yarn", **both)) == "hdfs://a"
    assert session.shared_folder(stub("local[2]")).endswith("/tillstone")


def test_tables_by_a_column_are_written_without_a_shuffle(spark, rows):
    """Each task writes a file per value, from the rows it has; a row without a value is kept too."""
    made = spark.range(0, 400, 1, 4).selectExpr("id", "if(id % 8 = 0, null, date'2001-01-01' + cast(id % 3 as int)) as day")
    kept = session.settled(made, "by-day", by="day")
    assert len(kept.inputFiles()) == 4 * 4
    assert kept.columns == made.columns and rows(kept) == rows(made)


def test_tables_by_a_column_are_written_from_small_splits(spark, monkeypatch):
    """What a task sorts is bounded, whatever the session reads at once; the session's own setting comes back."""
    name, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(session, "SPLIT", 1 << 20)
    made = spark.range(0, 2_000_000, 1, 1).selectExpr("id", "xxhash64(id) as noise", "date'2001-01-01' as day")
    landed = session.settled(made, "landed", splits=True)
    kept = session.settled(landed, "by-day", by="day")
    assert len(landed.inputFiles()) == 1 and len(kept.inputFiles()) >= 4
    assert kept.count() == 2_000_000 and spark.conf.get(name) == before


def test_wide_steps_read_small_shuffle_partitions(spark, monkeypatch):
    """What a task sorts after a shuffle is bounded, whatever the session reads at once; its own setting comes back."""
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst")
    before = [spark.conf.get(name) for name in names]
    monkeypatch.setattr(session, "SHUFFLED", 1 << 20)
    made = spark.range(0, 1_000_000, 1, 1).selectExpr("id", "xxhash64(id) as noise")
    dealt = lambda: made.repartition("id").sortWithinPartitions("id")
    try:
        spark.conf.set(names[0], "128m")
        spark.conf.set(names[1], "false")
        assert len(session.settled(dealt(), "narrow").inputFiles()) == 1
        kept = session.settled(dealt(), "wide", wide=True)
        assert spark.conf.get(names[0]) == "128m"
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)
    assert len(kept.inputFiles()) >= 4 and kept.agg({"id": "sum"}).first()[0] == 999_999 * 500_000


def test_documents_and_invoices_are_wide_steps(spark, monkeypatch):
    asked = {}
    plain = session.settled
    for module in (overlays, job):
        monkeypatch.setattr(module, "settled", lambda df, name, *a, **k: asked.update({name: k.get("wide", False)}) or plain(df, name, *a, **k))
    sources = overlays.Sources(spark, "/root/testdata/sf0.001")
    sources._prefix += "_wide"
    job.Job(sources).published_invoices  # noqa: B018 - landed and settled
    assert asked["title_document"] and asked["invoices"]

"""The shared folder and what jobs leave in it."""

import threading

import pytest

from telhado import session


class OnCluster:
    """A session whose master is not local and that names no shared folder."""

    class sparkContext:
        master, applicationId = "spark://host:7077", "app"

    class conf:
        @staticmethod
        def get(name, default=None):
            return default


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(OnCluster)
    assert session.is_local("local[8]") and session.is_local("local")
    assert not session.is_local("local-cluster[3,2,1024]") and not session.is_local("yarn")


def test_scratch_tables_belong_to_their_job(spark):
    other = []

    def elsewhere():
        other.append(session.materialise(spark.range(3), "other"))

    with session.scratch(spark):
        mine = session.materialise(spark.range(2), "mine")
        thread = threading.Thread(target=elsewhere)
        thread.start()
        thread.join()
        assert mine.count() == 2
    assert other[0].count() == 3
    with pytest.raises(Exception, match="(?i)exist"):
        spark.read.parquet(mine.inputFiles()[0]).count()


def test_paths_name_the_file_system(spark, tmp_path, monkeypatch):
    """A shared folder without a scheme lies where Spark's default file system is."""
    conf = spark._jsc.hadoopConfiguration()
    monkeypatch.setattr(session, "shared_dir", lambda spark: "/shared/x")
    assert session.fresh_path(spark, "x").startswith("/shared/x/x-")
    conf.set("fs.viewfs.mounttable.store.link./shared", tmp_path.as_uri())
    conf.set("fs.defaultFS", "viewfs://store/")
    try:
        assert session.fresh_path(spark, "x").startswith("viewfs://store/shared/x/x-")
    finally:
        conf.unset("fs.defaultFS")

import os

import pytest

from millrace import session
from millrace.plans import inputs


def test_the_named_folder_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert session.scratch_root(spark) == (named.rstrip("/") if named else session._own_scratch)


def test_scratch_folders_are_new_and_released_together(spark, path, monkeypatch):
    monkeypatch.setattr(session, "scratch_root", lambda _: path)
    folders = [session.scratch(spark, "part") for _ in range(2)]
    assert folders[0] != folders[1]
    for folder in folders:
        spark.range(1).write.parquet(folder)
    session.release_scratch(spark)
    assert not any(os.path.exists(folder) for folder in folders)


def test_databases_and_tables_are_released_with_the_folder(spark, path, monkeypatch):
    monkeypatch.setattr(session, "scratch_root", lambda _: path)
    database = inputs.new_database(spark)
    spark.range(3).write.saveAsTable(f"{database}.t")
    name = session.temporary(spark, "TABLE", f"default.kept_{os.getpid()}")
    spark.range(3).write.option("path", session.scratch(spark, "table")).saveAsTable(name)
    session.release_scratch(spark)
    assert not spark.catalog.databaseExists(database) and not spark.catalog.tableExists(name)
    assert not os.path.exists(f"{path}/millrace/{spark.sparkContext.applicationId}")


class _Cluster:
    """A session of a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(name, default):
            return default

    class sparkContext:
        master = "yarn"


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(_Cluster())

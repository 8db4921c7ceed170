"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for sessions this package starts itself (tests, bench). Library code
# never changes the settings of a session that is handed to it.
LOCAL_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_own_scratch: str | None = None
# Catalog entries made for intermediate results: (application, DATABASE or TABLE, name).
_temporary: list[tuple[str, str, str]] = []


def build_session(app: str, cores: int | str = 8, **settings: str) -> SparkSession:
    """Local session for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "8g"))
    )
    for name, value in {**LOCAL_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; every executor sees it.

    Only a session without that setting (a local test run) gets a temporary
    folder of its own.
    """
    global _own_scratch
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _own_scratch is None:
        _own_scratch = tempfile.mkdtemp(prefix="millrace-")
    return _own_scratch


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/millrace/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, label: str) -> str:
    """Path of a new, not yet existing folder below the shared scratch folder."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def temporary(spark: SparkSession, kind: str, name: str) -> str:
    """Note a DATABASE or TABLE that goes with the scratch folder; gives its name."""
    _temporary.append((spark.sparkContext.applicationId, kind, name))
    return name


def release_scratch(spark: SparkSession) -> None:
    """Delete what this application has written to scratch, and the catalog entries noted as temporary.

    For the end of a job: frames computed earlier may still read from there.
    """
    application = spark.sparkContext.applicationId
    for entry in [e for e in _temporary if e[0] == application]:
        spark.sql(f"DROP {entry[1]} IF EXISTS {entry[2]}{' CASCADE' if entry[1] == 'DATABASE' else ''}")
        _temporary.remove(entry)
    # Imported here because the file helper needs nothing from sessions.
    from millrace.files import Files

    Files(spark, _own_folder(spark)).delete()

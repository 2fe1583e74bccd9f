"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


UTC = ("UTC", "Etc/UTC", "GMT", "Z", "Zulu", "Universal", "Etc/GMT", "+00:00", "UCT")


def checked(spark: SparkSession) -> SparkSession:
    """Refuse a session whose time zone would shift the times that jobs here read; nothing is changed in it."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC:
        raise ValueError(f"the session's time zone is {zone}; set spark.sql.session.timeZone to UTC")
    return spark


def local_session(app: str = "anemos", cores: str = "8", memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    return checked(builder.getOrCreate())


#: The folder chosen for sessions that name none, by application.
_CHOSEN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Root for written tables: the cluster's checkpoint folder.

    Where the session names none and driver and executors are one process (tests), a temporary
    folder is chosen once per application. On a cluster that is an error, as each executor would
    write to its own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _CHOSEN:
            _CHOSEN[app] = tempfile.mkdtemp(prefix="anemos-")
        root = _CHOSEN[app]
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df, name: str):
    """Write a result to the shared folder and read it back.

    Used where a small result of a long plan is needed more than once: it is
    computed once, and a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

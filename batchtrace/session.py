"""Session construction and the shared scratch folder.

On a cluster the session already exists and carries its own settings; these
helpers only fill in what is unset (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Settings applied when this package creates the session. AQE re-plans joins
# from runtime sizes (broadcast only when the measured side is small),
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "batchtrace",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process on one machine."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only when
    neither is set and the master is local (tests) is a fresh local folder
    created and set; a cluster without the setting is an error, because a
    folder of the driver's machine would not be seen by the executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no context handle (remote session): the server's setting rules
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if sc is not None:
            if not current:
                if not is_local(sc.master):
                    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
                current = tempfile.mkdtemp(prefix="batchtrace-ckpt-")
            sc.setCheckpointDir(current)
            current = sc.getCheckpointDir() or current
        elif not current:
            raise RuntimeError("spark.checkpoint.dir is not set for this session")
    return current


def app_id(spark: SparkSession) -> str:
    """The application id, without needing a context handle."""
    return spark.conf.get("spark.app.id", None) or spark.sparkContext.applicationId


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name under the shared checkpoint folder.

    Used for stream checkpoints, round-trip sinks and materialised steps, so
    that every executor and a restarted driver see the same files.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/batchtrace-{name}-{uuid.uuid4().hex[:12]}"


def at_once(jobs: Iterable[Callable[[], object]], most: int = 8) -> list:
    """Run independent driver-side steps (each its own Spark jobs) side by side, so
    that small ones do not wait for each other; results in order, or the first failure."""
    with ThreadPoolExecutor(most) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def local_path(uri: str) -> str | None:
    """The local file path of a ``file:`` URI or plain path, else None."""
    if uri.startswith("file:"):
        p = uri[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
        return p
    if "://" in uri:
        return None
    return os.path.abspath(uri)

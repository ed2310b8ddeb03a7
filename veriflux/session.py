"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ARCHIVE = "veriflux-library.zip"


def build_session(app: str = "veriflux", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the datasets rely on.

    UTC keeps naive source times and `as_of` literals comparable; AQE picks reducer counts, splits
    skewed joins and turns joins into broadcasts from measured sizes.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_for(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a cluster job from the size of its largest shuffle.

    Reducers start at about 256 MB, at least two per core; AQE merges the ones that turn out small. Input
    splits of 256 MB keep the number of map outputs, and with it of shuffle blocks, in bounds.
    """
    target = 256 << 20
    return {
        "spark.sql.shuffle.partitions": str(max(2 * cores, math.ceil(shuffle_bytes / target))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": str(target),
    }


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    It lies below `spark.checkpoint.dir`. A local session without that setting gets a temporary
    folder; on a cluster there is no safe default, so a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="veriflux-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def ship_library(spark: SparkSession) -> None:
    """Sends this package to the Python workers of a session, once.

    The archive is made by the driver and served to executors by Spark itself, so no shared folder is needed.
    """
    context = spark.sparkContext
    if any(name.endswith(f"/{ARCHIVE}") for name in context.listFiles):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="veriflux-")) / ARCHIVE
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))

"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import SparkSession

from asterism import storage

# Results depend on these; they are set whatever the session says.
CORRECTNESS = {
    # Overflow and malformed input raise.
    "spark.sql.ansi.enabled": "true",
    # A JSON object that repeats a key keeps the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Speed depends on these; a value that the session was given stays.
TUNING = {
    # Let AQE swap a sort-merge join for a hash join when every build-side
    # partition was measured to be this small; wide rows then need no sort.
    # A hash table cannot spill, so none is built of more than a task's share.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
    "spark.sql.adaptive.enabled": "true",
    # Size of the tasks, and so of the files, behind a shuffle. It counts
    # compressed bytes: a row of a key and a number takes 8 of them and 80 in a
    # sort, so a task of 16 MB may need 160 MB.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session someone else created."""
    for key, value in TUNING.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    for key, value in CORRECTNESS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", app: str = "asterism", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
    )
    for key, value in {**CORRECTNESS, **TUNING, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Put this package on the path of the session's Python workers.

    Does what ``spark-submit --py-files`` does, for sessions that were started
    otherwise; nothing where the workers' PYTHONPATH has it already.
    """
    root, app_id = Path(__file__).resolve().parents[1], spark.sparkContext.applicationId
    known = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known and app_id not in _shipped:
        archive = f"{tempfile.mkdtemp(prefix='asterism-')}/asterism.zip"
        atexit.register(shutil.rmtree, os.path.dirname(archive), ignore_errors=True)
        with zipfile.ZipFile(archive, "w") as packed:
            for module in Path(__file__).parent.rglob("*.py"):
                packed.write(module, module.relative_to(root))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app_id)
    return spark


_local_scratch: dict[str, str] = {}
_scratch_base: ContextVar[str | None] = ContextVar("scratch_base", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The session's own folder below ``spark.checkpoint.dir``.

    On a cluster the setting has to name storage every executor reaches. A run
    without it uses a folder below its warehouse. Else a machine-local folder
    is made up, for local mode only, and deleted when Python ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _scratch_base.get()
    app_id = spark.sparkContext.applicationId
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        if app_id not in _local_scratch:
            _local_scratch[app_id] = tempfile.mkdtemp(prefix="asterism-")
            atexit.register(shutil.rmtree, _local_scratch[app_id], ignore_errors=True)
        root = _local_scratch[app_id]
    return f"{root.rstrip('/')}/asterism-{app_id}"


_scratch_in_use: ContextVar[list[str] | None] = ContextVar("scratch_in_use", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    in_use = _scratch_in_use.get()
    if in_use is not None:
        in_use.append(path)
    return path


@contextmanager
def scratch_released(spark: SparkSession, base: str | None = None) -> Iterator[None]:
    """Delete the scratch tables made inside the block when it ends.

    For work that has stored its results by then; frames handed out of the
    block must not read from scratch. ``base`` is where scratch goes when
    ``spark.checkpoint.dir`` is not set.
    """
    in_use: list[str] = []
    token = _scratch_in_use.set(in_use)
    base_token = _scratch_base.set(base or _scratch_base.get())
    try:
        yield
    finally:
        _scratch_in_use.reset(token)
        _scratch_base.reset(base_token)
        for path in in_use:
            storage.delete(spark, path)

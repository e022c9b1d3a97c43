"""Session helpers. The library itself never needs a particular session."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from touchline import contract as C


def local_session(
    cpus: int | str = "*", app: str = "touchline", settings: dict[str, str] | None = None
) -> SparkSession:
    """A session for tests and the bench. On a cluster use the session the cluster gives you."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A new path for intermediate output, in the given folder or else in the shared one of spark.checkpoint.dir.

    Without either, a temporary folder of this machine is used if the master is local; on several machines, which
    would each write to a disk of their own, it is an error.
    """
    shared = folder or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError(C.MSG_NO_SCRATCH)
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_conf_lock = threading.Lock()
_conf_held: dict[tuple[int, str], tuple[int, str, str | None]] = {}  # (session, name) to holders, value, value before


@contextmanager
def session_conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Set session options (dots written as double underscores) and put the old values back.

    Several threads may hold the same value in one session at once; the last one puts the old value back. A thread that wants
    another value meanwhile gets an error.
    """
    names = {key.replace("__", "."): value for key, value in settings.items()}
    taken = []
    try:
        for name, value in names.items():
            key = (id(spark), name)
            with _conf_lock:
                holders, held, before = _conf_held.get(key, (0, value, spark.conf.get(name, None)))
                if held != value:
                    raise RuntimeError(f"{name} is held at {held} by another thread")
                spark.conf.set(name, value)
                _conf_held[key] = (holders + 1, value, before)
            taken.append(key)
        yield
    finally:
        for key in taken:
            with _conf_lock:
                holders, value, before = _conf_held.pop(key)
                if holders > 1:
                    _conf_held[key] = (holders - 1, value, before)
                elif before is None:
                    spark.conf.unset(key[1])
                else:
                    spark.conf.set(key[1], before)

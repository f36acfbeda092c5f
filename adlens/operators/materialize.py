"""Materialised tables in the shared checkpoint folder.

Long lineages (the star schema, the cleaned reviews, the user documents) are
written once as parquet under ``spark.checkpoint.dir`` and read back, like
the tables a warehouse load produces. The folder name carries a fingerprint
of the input files, so changed inputs build a fresh copy; a table counts as
present only when its ``_SUCCESS`` marker exists (a half-written table from a
lost job is rewritten).
"""

from __future__ import annotations

import gc
import hashlib
import threading
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir


# Serialises the one-time builds of materialised tables within a process
# (re-entrant: a build may load the tables it depends on).
BUILD_LOCK = threading.RLock()
#: Part of every fingerprint: raise it when a table's build changes.
BUILD_VERSION = "6"

#: Until the JVM has heard which frames Python no longer holds: py4j's worker
#: looks for them once a second.
PY4J_SECONDS = 2


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def committed_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path`` whose write was committed."""
    if not path_exists(spark, path):
        return []
    p, fs = _fs(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return sorted(n for n in names if path_exists(spark, f"{path}/{n}/_SUCCESS"))


def remove_path(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def input_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Hash of the build version and of every input file below the paths: its
    path, length and modification time (an object store's folders carry no
    time of their own, and a file can change inside an unchanged folder)."""
    h = hashlib.sha1(BUILD_VERSION.encode())
    for path in sorted(paths):
        p, fs = _fs(spark, path)
        h.update(f"{path};".encode())
        files = fs.listFiles(p, True)
        found = []
        while files.hasNext():
            st = files.next()
            found.append(f"{st.getPath()}|{st.getLen()}|{st.getModificationTime()};")
        h.update("".join(sorted(found)).encode())
    return h.hexdigest()[:16]


def table_root(spark: SparkSession, *parts: str) -> str:
    """Below the shared folder itself, not the sub-folder that Spark makes in
    it for each application: a later application finds the same tables."""
    shared = checkpoint_dir(spark).rstrip("/").rsplit("/", 1)[0]
    return "/".join([shared, "adlens-tables", *parts])


def _commit(spark: SparkSession, built: str, path: str) -> None:
    """Give a finished folder its shared name, unless another application was
    first: then its copy stays and this one goes."""
    src, fs = _fs(spark, built)
    dst, _ = _fs(spark, path)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst) and not path_exists(spark, f"{path}/_SUCCESS"):
        fs.delete(dst, True)                     # half a copy of a lost job
    if fs.exists(dst) or not fs.rename(src, dst):
        fs.delete(src, True)
        return
    inner, _ = _fs(spark, f"{path}/{src.getName()}")
    if fs.exists(inner):                         # both came at once: a rename into the other's folder
        fs.delete(inner, True)


def bloom_options(cols: Sequence[str]) -> dict[str, str]:
    """Parquet writer options: a bloom filter per row group for each column, as
    large as its distinct values need (up to the format's 1 MB)."""
    return {f"parquet.bloom.filter.enabled#{c}": "true" for c in cols} | (
        {"parquet.bloom.filter.adaptive.enabled": "true"} if cols else {})


def write_once(spark: SparkSession, path: str, build: Callable[[], DataFrame],
               partition_by: Sequence[str] = (), schema=None, blooms: Sequence[str] = (), write: Callable[[DataFrame, str], object] | None = None,
               options: dict[str, str] | None = None, release: bool = False) -> DataFrame | None:
    """Write ``build()`` to ``path`` unless a committed copy exists; read it back
    (with ``schema`` when given, e.g. to keep partition values as text).

    Every writer fills a folder of its own and renames it when it is done, so
    of several applications one copy wins and none deletes what another reads.
    ``blooms`` names columns that get a bloom filter a row group, for reads of
    single keys, ``options`` are further ones of the parquet writer. ``write(df, folder)`` stands in for the parquet writer;
    nothing is read back then. ``release`` lets go of the build's shuffle files
    at once: Spark keeps them until the driver's garbage is collected, here all
    through what follows the build."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        df = build()
        own = f"{path}.{uuid.uuid4().hex[:12]}"
        if write is not None:
            write(df, own)
        else:
            w = df.write
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.options(**bloom_options(blooms), **(options or {})).parquet(own)
            if schema is None and not partition_by:
                schema = df.schema   # known: skip the footer-reading job on read-back
        _commit(spark, own, path)
        if release:
            del df
            gc.collect()
            time.sleep(PY4J_SECONDS)
            spark.sparkContext._jvm.System.gc()
    if write is not None:
        return None
    r = spark.read.schema(schema) if schema is not None else spark.read
    return r.parquet(path)

"""Session helpers: reuse the caller's session, find the shared scratch root."""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def get_spark(app_name: str = "pagelake", master: str | None = None) -> SparkSession:
    """Active session if there is one, else a new one with sane defaults.

    On a cluster the session is created by the launcher and simply reused;
    the local defaults below only matter for tests and the bench.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    return (
        b.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # pages can be large: bound each Arrow batch handed to the parser by bytes too
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 * 1024 * 1024))
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """A folder every executor can reach.

    ``spark.checkpoint.dir`` names the cluster's shared folder; it is read
    from the session and only set here when it is unset (local runs), in
    which case a folder under the warehouse directory is used.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        conf = spark.sparkContext.getCheckpointDir()
    if conf:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(conf)
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    wh = spark.conf.get("spark.sql.warehouse.dir")
    if wh.startswith("file:"):
        wh = wh[len("file:"):]
    root = os.path.join(wh, "_pagelake_shared")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def _package_zip() -> tuple[str, bytes]:
    """The ``pagelake`` package as zip bytes, named by a content hash."""
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, dirs, files in os.walk(pkg_dir):
            dirs[:] = sorted(d for d in dirs if d != "__pycache__")
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.writestr(os.path.relpath(full, base), open(full, "rb").read())
    data = buf.getvalue()
    return f"pagelake-{hashlib.sha256(data).hexdigest()[:16]}.zip", data


def ship_package(spark: SparkSession) -> None:
    """Make ``pagelake`` importable in the executors' Python workers.

    The parse step runs Python on the executors; they import this package.
    The package is zipped on the driver and registered with ``addPyFile``
    (like ``--py-files``), once per application: placed in the shared
    folder named by ``spark.checkpoint.dir`` when the cluster sets one,
    otherwise served by the driver.  Harmless where the package is already
    installed.
    """
    try:
        sc = spark.sparkContext
        key = sc.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect): ship with --py-files
        return
    if key in _SHIPPED:
        return
    name, data = _package_zip()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        # the cluster's shared folder: executors fetch the zip from there
        path = f"{configured.rstrip('/')}/_pyfiles/{name}"
        jvm = sc._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = jpath.getFileSystem(sc._jsc.hadoopConfiguration())
        if not fs.exists(jpath):
            out = fs.create(jpath, True)
            try:
                out.write(bytearray(data))
            finally:
                out.close()
    else:
        # local runs: the driver serves the file to its executors
        folder = tempfile.mkdtemp(prefix="pagelake-pyfiles-")
        path = os.path.join(folder, name)
        with open(path, "wb") as fh:
            fh.write(data)
    sc.addPyFile(path)
    _SHIPPED.add(key)

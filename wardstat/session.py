"""Session settings and the shared scratch folder."""

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Applied only where the caller or the cluster has not set a value. Adaptive
# execution does the sizing: it merges small shuffle partitions, splits hot
# ones and switches a join to broadcast once the side's real size is known.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Opening a file costs more than a few rows in it: small partitions of a write
    # are spread over the cores instead of being merged into one task.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
}

# Folders of sessions that have no shared one, by application; removed at exit.
_LOCAL_ROOTS = {}

# Can only be given when a session is started. Recording the Python line behind
# every column expression makes building a plan several times slower.
START_DEFAULTS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app_name="wardstat", master=None, **conf):
    """Get or create a session. Keyword names use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    named = {key.replace("__", "."): str(value) for key, value in conf.items()}
    for key, value in {**START_DEFAULTS, **named}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def scratch_path(spark, label):
    """A new path below the folder all executors share.

    The folder is the cluster's ``spark.checkpoint.dir``. Only a local session
    without that setting may fall back to a machine-local folder, which goes when
    the process ends. ``local-cluster`` has executors of its own and is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        application = spark.conf.get("spark.app.id", "")
        if application not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="wardstat-")
            atexit.register(shutil.rmtree, _LOCAL_ROOTS[application], ignore_errors=True)
        root = _LOCAL_ROOTS[application]
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"

"""Session construction and shared cluster settings."""

from __future__ import annotations

import os
import tempfile
import warnings

from pyspark.sql import SparkSession

_LOCAL_CHECKPOINT_ROOT: str | None = None
_HUGE_METHODS = "-XX:-DontCompileHugeMethods"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "stratus", extra: dict | None = None) -> SparkSession:
    """Session with the settings every stratus job assumes.

    * session time zone pinned to UTC (timestamps in the data are naive),
    * AQE on, including skew-join splitting and partition coalescing,
    * no web UI.
    On a cluster pass ``master=None`` and let spark-submit decide.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("STRATUS_DRIVER_MEMORY", "12g"))
        # Wide feature projections (60+ columns) generate methods above
        # HotSpot's 8 KB "huge method" limit, which are then never JIT-compiled
        # and run interpreted.  Here this process launches the JVM; on a
        # cluster pass the same flag through spark-submit (driver and
        # executors) so it joins the cluster's own JVM options.
        conf["spark.driver.extraJavaOptions"] = _HUGE_METHODS
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it if needed.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that value
    always wins.  Only a local-mode session without the setting (tests,
    laptops) gets a private folder under the system temp directory.
    """
    global _LOCAL_CHECKPOINT_ROOT
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(configured)
        return configured
    current = sc._jsc.sc().getCheckpointDir()
    if not current.isEmpty():
        return current.get()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    if _LOCAL_CHECKPOINT_ROOT is None:
        _LOCAL_CHECKPOINT_ROOT = tempfile.mkdtemp(prefix="stratus-ckpt-")
    sc.setCheckpointDir(_LOCAL_CHECKPOINT_ROOT)
    return _LOCAL_CHECKPOINT_ROOT


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


# About 1 GiB of (compressed) input per shuffle partition: 100 TB gives some
# 93,000 reducers, whose map statuses the driver can still hold; a partition
# that does not fit in memory spills.
DEFAULT_INPUT_BYTES_PER_PARTITION = 1024 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 100_000
_UNKNOWN_SIZE = 1 << 62


def partitions_for(df, bytes_per_partition: int = DEFAULT_INPUT_BYTES_PER_PARTITION) -> int:
    """Partitions for a full shuffle of ``df``: the session's, or more if they would exceed ``bytes_per_partition``.

    AQE coalesces partitions that come out small but never splits large ones
    (outside skew joins), so the count must follow the data: 100 TB needs some
    93,000 partitions, not the default 200.  The size is the sum of the plan's
    leaf relations (file sizes for scans): the bytes read, which joins or
    explodes above them cannot inflate.  No data is read, no setting changed.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = 0
    for i in range(leaves.size()):
        est = leaves.apply(i).stats().sizeInBytes()
        est = est if isinstance(est, int) else int(est.toString())
        if est < _UNKNOWN_SIZE:  # leaves without statistics report Long.MaxValue
            size += est
    need = max(1, -(-size // bytes_per_partition))
    if need > MAX_SHUFFLE_PARTITIONS:
        warnings.warn(f"{need} shuffle partitions wanted for {size} bytes, {MAX_SHUFFLE_PARTITIONS} used: "
                      "partitions are larger than asked for", stacklevel=2)
        need = MAX_SHUFFLE_PARTITIONS
    return max(need, shuffle_partitions(df.sparkSession))


def scale_shuffle_partitions(df, bytes_per_partition: int = DEFAULT_INPUT_BYTES_PER_PARTITION) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to :func:`partitions_for`; return the value in force.
    The setting is only ever raised."""
    need = partitions_for(df, bytes_per_partition)
    if need > shuffle_partitions(df.sparkSession):
        df.sparkSession.conf.set("spark.sql.shuffle.partitions", str(need))
    return need


#: HotSpot never compiles a method of more bytecode than this, unless told to.
HOTSPOT_METHOD_LIMIT = 8000


def compile_wide(df):
    """``df``; a stage whose generated method HotSpot would interpret runs by smaller methods, one per few columns.

    Sessions with :data:`_HUGE_METHODS` do not need it, but a cluster's own JVM options may lack that flag.
    """
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.codegen.hugeMethodLimit")) > HOTSPOT_METHOD_LIMIT:
        conf.set("spark.sql.codegen.hugeMethodLimit", str(HOTSPOT_METHOD_LIMIT))
    return df

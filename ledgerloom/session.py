"""Session settings the operators rely on, the package on the workers, and the shared folder for intermediate tables."""
import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime SQL settings. All of them can be changed on a running session, so a
# job may apply them to the session its cluster hands out.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Keyed state of streams: on disk instead of the heap, and a batch sends the keys it changed to the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: str = "8") -> SparkSession:
    """Session for tests and the local benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # No call-site capture per column: large expressions are built faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Without that setting only a local master gets a folder of its own, as the
    executors of a cluster could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="ledgerloom-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> SparkSession:
    """Give Python workers this package, once per context: functions are sent by name, and a worker has to be able to import them."""
    context = spark.sparkContext
    if not getattr(context, "_ledgerloom_shipped", False):
        package = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="ledgerloom-code-")  # read by the driver alone, which serves it to the workers
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        with zipfile.ZipFile(f"{folder}/ledgerloom.zip", "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, str(file.relative_to(package.parent)))
        context.addPyFile(f"{folder}/ledgerloom.zip")
        context._ledgerloom_shipped = True
    return spark

import tempfile

from pyspark.sql import SparkSession


def make_session(**conf) -> SparkSession:
    builder = (SparkSession.builder.master("local[8]").appName("meterflow-tests")
               .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
               .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false"))
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

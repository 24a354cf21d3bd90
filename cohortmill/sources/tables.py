"""Tables by path: parquet, CSV and whatever format the session has a connector for (delta, orc, json)."""

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """A table by path.  CSV has a header; without a schema its types are inferred, which costs a pass."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(path)


def union_sites(tables: dict[str, DataFrame]) -> DataFrame:
    """Union by column name of tables tagged with their site; columns a site lacks become null."""
    tagged = [df.withColumn("site", F.lit(site)) for site, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def read_sites(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", schema=None, **options) -> DataFrame:
    return union_sites({site: read_table(spark, path, fmt, schema, **options) for site, path in paths.items()})


def read_present(spark: SparkSession, paths: dict, fmt: str = "csv", **options) -> dict:
    """The tables whose path exists, by the same keys."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def exists(path):
        p = hadoop(path)
        return p.getFileSystem(conf).exists(p)

    return {key: read_table(spark, path, fmt, **options) for key, path in paths.items() if exists(path)}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=(), **options) -> str:
    """Overwrite, schema included.  ``partition_by`` (e.g. site) lets later reads prune folders."""
    writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.options(**options).save(path)
    return path


def write_list(df: DataFrame, path: str, column: str = "feature_id") -> str:
    """One value per line."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
    return path


def read_list(spark: SparkSession, path: str, column: str = "feature_id") -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias(column))


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)

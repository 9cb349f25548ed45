"""Tables between the phases, metric files, score stores, and where scratch tables live."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearcurve.sources.schema import SERIES

STAGES = T.StructType([*SERIES.fields, T.StructField("degradation_stage", T.IntegerType())])


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster. Only where none is named and all runs in one process, a local one is set."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="wearcurve-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/wearcurve/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def require_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Fail with all missing inputs named, before a long run starts."""
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError("missing input: " + ", ".join(missing))


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> None:
    """Sink of a phase. CSV files carry a header; ``sort_by`` orders rows inside each file."""
    rows = df.sortWithinPartitions(*sort_by) if sort_by else df
    writer = rows.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        # enforce matching column names: a reordered file must not be read by position
        return reader.option("header", True).option("enforceSchema", False).csv(path)
    return reader.format(fmt).load(path)


def write_scores(scores: DataFrame, path: str, key: str | None = None) -> None:
    """Append (params, score) rows to a JSON score store; with ``key`` they replace what was written with that key."""
    writer = scores.select("params", "score").write
    if key is None:
        writer.mode("append").json(path)
    else:
        writer.mode("overwrite").json(f"{path}/{hashlib.sha256(key.encode()).hexdigest()[:32]}")


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).schema("params string, score double").json(path)


def read_score_map(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object {params: score} as (params, score) rows."""
    text = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", T.MapType(T.StringType(), T.DoubleType()))
    return text.select(F.explode(parsed).alias("params", "score"))


def params_key(params: Mapping) -> str:
    return json.dumps(dict(params), sort_keys=True)


def unscored(candidates: DataFrame, scores: DataFrame) -> DataFrame:
    """Candidates without a stored score."""
    return candidates.join(scores.select("params"), "params", "left_anti")

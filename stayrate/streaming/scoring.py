"""Daily churn scoring.

``fit_churn_pipeline`` builds a ``PipelineModel`` (assembler, scaler,
boosted trees) that can be saved and reloaded.  ``score_daily`` scores one
day's feature snapshot and writes it into a table partitioned by ``as_of``
(dynamic partition overwrite, so re-running a day replaces only that day).
``stream_scores`` does the same incrementally with Structured Streaming:
new daily snapshot files are picked up from a folder, scored and appended,
with progress kept in a checkpoint location.  ``stream_daily`` commits each micro-batch
atomically under its number, so a job that dies at any point, before or after a commit,
resumes without losing a day or scoring one twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stayrate.operators import features as fe
from stayrate.sources.sinks import read_batches, write_batch

LABEL = "churn_30d"


def fit_churn_pipeline(labelled: DataFrame, cols: Sequence[str] | None = None, n_trees: int = 200,
                       max_depth: int = 4, seed: int = 42):
    """Fit assembler -> scaler -> boosted trees on the labelled feature table."""
    cols = list(cols or [c for c in fe.model_columns(labelled) if c != LABEL])
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=cols, outputCol="raw_features", handleInvalid="keep"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        GBTClassifier(featuresCol="features", labelCol=LABEL, maxIter=n_trees, maxDepth=max_depth,
                      stepSize=0.1, seed=seed, cacheNodeIds=True, checkpointInterval=10),
    ])
    train = labelled.withColumn(LABEL, F.col(LABEL).cast("double"))
    return pipe.fit(train), cols


def save_pipeline(model: PipelineModel, path: str) -> PipelineModel:
    """Save the fitted pipeline and return it reloaded from ``path`` (what a
    daily job on another cluster would load)."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def score(model: PipelineModel, features: DataFrame, as_of) -> DataFrame:
    """Churn probability and class for every customer, stamped with ``as_of``."""
    p = model.transform(features)
    return p.select("customer_id", vector_to_array("probability")[1].alias("churn_probability"),
                    F.col("prediction").cast("int").alias("predicted_churn"),
                    F.lit(str(as_of)).cast("date").alias("as_of"))


def score_daily(spark: SparkSession, model: PipelineModel, features: DataFrame, as_of,
                path: str) -> DataFrame:
    """Write one day's scores into ``path`` (partitioned by ``as_of``) and
    return that day's partition read back (partition pruning).

    ``path`` is the table of one customer base; other days there stay."""
    (score(model, features, as_of).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("as_of").parquet(path))
    return spark.read.parquet(path).where(F.col("as_of") == F.lit(str(as_of)).cast("date"))


def stream_scores(spark: SparkSession, model: PipelineModel, snapshots_dir: str, out_dir: str,
                  checkpoint_location: str, schema, available_now: bool = True) -> StreamingQuery:
    """Score daily feature snapshots (Parquet files carrying an ``as_of``
    column) as they arrive; append to ``out_dir`` partitioned by ``as_of``."""
    src = spark.readStream.schema(schema).parquet(snapshots_dir)
    p = model.transform(src)
    out = p.select("customer_id", vector_to_array("probability")[1].alias("churn_probability"),
                   F.col("prediction").cast("int").alias("predicted_churn"), "as_of")
    writer = (out.writeStream.format("parquet").outputMode("append").partitionBy("as_of")
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 day")
    return writer.start(out_dir)


SCORES = "customer_id long, churn_probability double, predicted_churn int, as_of date"


def stream_daily(spark: SparkSession, model: PipelineModel, snapshots_dir: str, out_dir: str, checkpoint_location: str,
                 schema, files_per_batch: int | None = 1, on_batch=None) -> StreamingQuery:
    """Score the snapshot files of a folder that are new since the last run, then stop (availableNow).

    A batch is scored, written to a folder of its own and committed by one rename under its
    number (``write_batch``); read the scores with ``read_scores``.  ``on_batch(id)`` is called
    after a commit, before the stream records the batch as done.  ``files_per_batch`` None makes
    all new files one batch: a day's snapshot may then be of any number of files.
    """
    def one(df: DataFrame, batch: int) -> None:
        p = model.transform(df)
        scores = p.select(F.col("customer_id").cast("long").alias("customer_id"), vector_to_array("probability")[1].alias("churn_probability"),
                          F.col("prediction").cast("int").alias("predicted_churn"), "as_of")
        write_batch(scores, out_dir, batch)
        if on_batch:
            on_batch(batch)

    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    src = reader.parquet(snapshots_dir)
    return (src.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())


def read_scores(spark: SparkSession, out_dir: str) -> DataFrame:
    """All committed scores of ``stream_daily``."""
    return read_batches(spark, out_dir, SCORES)

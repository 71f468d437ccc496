"""Label index as a table: labels numbered by frequency and joined to the rows.

Nothing is collected but the few heaviest labels, so the number of labels has no bound.
"""

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
)
from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from wavelode.session import work_dir

# A label with more than one in HEAVY_SHARE of the rows is joined in SALTS places.
HEAVY_SHARE = 50
SALTS = 32


def label_counts(df, column):
    """Labels, most frequent first and ties alphabetical: the index order."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.asc(column))
    )


def numbered(ordered, path):
    """Write sorted rows with their position in the order, from 0.

    The sort puts ranges of the order into tasks; a position is the rows of the tasks
    before plus the place within the task.
    """
    spark = ordered.sparkSession
    in_task = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ordered.select(
        "*", F.spark_partition_id().alias("task"), in_task.alias("place")
    ).write.parquet(f"{path}/ordered")
    rows = spark.read.parquet(f"{path}/ordered")
    sizes = rows.groupBy("task").agg(F.count("*").alias("n"))
    # One row per task of the sort.
    before = sizes.select(
        "task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before")
    )
    rows.join(F.broadcast(before), "task").select(
        *ordered.columns, (F.col("before") + F.col("place")).alias("position")
    ).write.parquet(f"{path}/labels")
    return spark.read.parquet(f"{path}/labels")


class _LabelWriter(DefaultParamsWriter):
    def saveImpl(self, path):
        super().saveImpl(path)
        self.instance.table().write.parquet(f"{path}/labels")


class _LabelReader(DefaultParamsReader):
    def load(self, path):
        index = super().load(path)
        return index._set(tablePath=f"{path}/labels")


class LabelIndex(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable,
                 DefaultParamsWritable):
    """Adds a label's number; null and unseen labels share the number after the last.

    The table of labels is joined from the left. Spark broadcasts it only under its own
    size threshold; otherwise rows of heavy labels and of null are spread by salt.
    """

    tablePath = Param(Params._dummy(), "tablePath", "folder of (label, position)",
                      TypeConverters.toString)
    labelCount = Param(Params._dummy(), "labelCount", "number of labels", TypeConverters.toInt)
    heavy = Param(Params._dummy(), "heavy", "labels joined in several places",
                  TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, tablePath=None, labelCount=None,
                 heavy=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def table(self):
        spark = SparkSession.getActiveSession()
        return spark.read.parquet(self.getOrDefault(self.tablePath))

    def write(self):
        return _LabelWriter(self)

    @classmethod
    def read(cls):
        return _LabelReader(cls)

    def _transform(self, df):
        column, output = self.getInputCol(), self.getOutputCol()
        count = self.getOrDefault(self.labelCount)
        heavy = self.getOrDefault(self.heavy)
        simple = [f.name for f in df.schema if f.dataType.typeName() not in
                  ("udt", "array", "map", "struct", "vectorudt", "variant")]
        place = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in simple]), F.lit(SALTS)).cast("int")
        label = F.col(f"`{column}`")
        spread = label.isNull() | label.isin(heavy) if heavy else label.isNull()
        table = self.table()
        salts = F.when(F.col("label").isin(heavy), F.sequence(F.lit(0), F.lit(SALTS - 1))) \
            if heavy else F.lit(None).cast("array<int>")
        table = table.select(
            F.col("label").alias("__label"), F.col("position").alias("__position"),
            F.explode(F.coalesce(salts, F.array(F.lit(0)))).alias("__salt"),
        )
        salted = df.withColumn("__at", F.when(spread, place).otherwise(0))
        joined = salted.join(
            table, (label == F.col("__label")) & (F.col("__at") == F.col("__salt")), "left"
        )
        number = F.coalesce("__position", F.lit(count)).cast("double")
        kind = {"ml_attr": {"type": "nominal", "name": output, "num_vals": count + 1}}
        kept = [F.col(f"`{c}`") for c in df.columns if c != output]
        return joined.select(*kept, number.alias(output, metadata=kind))


def fit_label_index(df, column, output=None):
    """Index labels by frequency, ties alphabetical, as a table under the work folder."""
    path = work_dir(df.sparkSession, "label-index")
    named = label_counts(df, column).withColumnRenamed(column, "label")
    table = numbered(named.withColumn("label", F.col("label").cast("string")), path)
    total = table.agg(F.count("*").alias("labels"), F.sum("count").alias("rows")).first()
    # Fewer than HEAVY_SHARE labels can have so many rows.
    heavy = [r["label"] for r in table.filter(
        F.col("count") * HEAVY_SHARE > (total["rows"] or 0)).select("label").collect()]
    return LabelIndex(
        inputCol=column, outputCol=output or f"{column}_index", tablePath=f"{path}/labels",
        labelCount=total["labels"], heavy=heavy,
    )

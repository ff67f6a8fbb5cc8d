"""Run in its own process (its own SparkContext with task retries): a task
fails on its first attempt - once upstream of the range numbering and once
downstream of it - and the ranks must still equal the single-window
reference. Prints OK on success."""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import Window
from pyspark.sql import functions as F  # noqa: E402

from pitchline.operators.ranking import global_row_number, rank_within  # noqa: E402


MARKS = tempfile.mkdtemp(prefix="pl-retry-marks-", dir="/tmp")


def flaky(partition: int, tag: str):
    @F.udf("long")
    def f(x):  # test-only: simulates a lost executor on the first attempt
        tc = TaskContext.get()
        if tc.attemptNumber() == 0 and tc.partitionId() == partition:
            open(os.path.join(MARKS, f"{tag}-{tc.stageId()}"), "w").close()
            raise RuntimeError("simulated executor loss")
        return x
    return f


def main() -> None:
    spark = (SparkSession.builder.master("local[4,3]").appName("retry-probe")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "6")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pl-retry-", dir="/tmp"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    base = spark.range(20000).repartition(4).select(
        "id", (F.col("id") % 97).alias("g"), (F.col("id") * 7 % 13).alias("p"))
    order = [F.col("p").desc(), F.col("id")]
    expected = {r.id: r.rn for r in base.withColumn(
        "rn", F.row_number().over(Window.orderBy(*order))).collect()}

    upstream = base.withColumn("id", flaky(1, "up")("id"))
    got = {r.id: r.rn for r in global_row_number(upstream, order, "rn").collect()}
    assert got == expected, "upstream retry changed the ranks"

    ranked = global_row_number(base, order, "rn")
    down = ranked.withColumn("rn", flaky(0, "down")("rn"))
    got = {r.id: r.rn for r in down.collect()}
    assert got == expected, "downstream retry changed the ranks"

    exp_g = {r.id: r.r for r in base.withColumn(
        "r", F.row_number().over(Window.partitionBy("g").orderBy(*order))).collect()}
    got_g = {r.id: r.r for r in rank_within(upstream, ["g"], order, "r").collect()}
    assert got_g == exp_g, "grouped ranks changed under retry"
    spark.stop()
    marks = os.listdir(MARKS)
    assert any(m.startswith("up-") for m in marks) and any(m.startswith("down-") for m in marks), marks
    print("OK")


if __name__ == "__main__":
    main()

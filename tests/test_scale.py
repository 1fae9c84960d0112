"""Plans under skew: no window over raw rows, hot keys are folded or split."""

import pytest
from pyspark.sql import functions as F

from tallyline.operators import groups as G
from tallyline.operators import joins as J
from tallyline.plans import cleaning as K
from tallyline.plans.release import check_release


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def at_scale(spark):
    """No broadcasts, and thresholds small enough for test data to count as large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, n=300_000):
    """A third of the rows share one key; the payload resists compression."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    return spark.range(n).select(key.alias("k"), F.col("id").alias("v"), F.md5(F.col("id").cast("string")).alias("pad"))


def test_group_stats_split_the_hot_key(at_scale):
    df = G.with_group_stats(hot(at_scale), ["k"], n=F.count(F.lit(1)))
    plan = final_plan(df)
    assert "Window" not in plan and "skewed" in plan
    assert df.where("k = 7").agg(F.min("n"), F.count("*")).head() == (100_040, 100_040)


@pytest.mark.parametrize("make", [
    lambda df: G.filter_modes(df.withColumn("mode", F.when(F.col("v") % 2 == 0, "TOTAL").otherwise("MAIL")), ["k"], "drop_parts"),
    lambda df: G.keep_group_min(df, ["k"], F.col("v")),
    lambda df: G.null_unless_group_min(df, ["k"], "v", ["pad"], F.lit(False)),
    lambda df: G.attach_ids(df, ["k"]).select("k", "v", "pad", "id"),
    lambda df: J.redact(df, df.where("v < 50").select("k", "v", F.lit("G").alias("g")), ["k", "v"], {"pad": "g"}, check=False),
    lambda df: K.infer_undervotes(df.withColumns({"cell": F.lit("0"), "named": F.lit("x")}), "cell", "named", ["k"]),
], ids=["filter_modes", "keep_group_min", "null_unless_group_min", "attach_ids", "redact", "infer_undervotes"])
def test_no_task_gathers_the_hot_key(at_scale, make):
    df = make(hot(at_scale))
    df.write.format("noop").mode("overwrite").save()
    tracker = at_scale.sparkContext._jsc.sc().statusStore()
    gateway = at_scale.sparkContext._gateway
    stages = tracker.stageList(None, False, False, gateway.new_array(at_scale._jvm.double, 0), None)
    quantile = gateway.new_array(at_scale._jvm.double, 1)
    quantile[0] = 1.0
    newest = max(stages.apply(k).stageId() for k in range(stages.size()))
    largest = 0
    for k in range(stages.size()):
        stage = stages.apply(k)
        if stage.stageId() > newest - 6:
            summary = tracker.taskSummary(stage.stageId(), stage.attemptId(), quantile)
            if summary.isDefined():
                largest = max(largest, summary.get().shuffleReadMetrics().readRecords().apply(0))
    # the hot key alone holds 100,000 rows of 300,000
    assert largest < 80_000


def test_duplicates_of_a_hot_key_fold_before_the_shuffle(at_scale):
    rows = hot(at_scale).withColumn("one", F.lit(1))
    plan = final_plan(G.first_per_key(rows, ["k"], ["v"]))
    assert "Window" not in plan and "partial_min" in plan


def test_release_check_counts_map_side(at_scale):
    rows = at_scale.range(1000).select(
        F.lit("S").alias("state"), F.lit("C").alias("county_name"), F.col("id").alias("cvr_id"), F.lit("GOVERNOR").alias("office"), F.lit("1").alias("district")
    )
    check_release(rows)

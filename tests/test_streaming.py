"""Row-local operators on a stream: rules, serving features, model scoring."""

from pyspark.sql import functions as F

from sparkcast.operators import features as fe
from sparkcast.operators import models as M
from sparkcast.sources.tables import table_path
from sparkcast.streaming import scoring as S

SF = "/root/testdata/sf0.001"


def test_stream_rules_match_batch(spark):
    lines = S.read_lineitem_stream(spark, S.stream_glob(table_path(SF, "lineitem")))
    tagged = S.tag_requests(S.requests_from_lineitem(lines))
    out = S.run_available_now(tagged.select("l_orderkey", "l_linenumber", F.size("reasons").alias("n")), "t-rules")
    batch = S.tag_requests(S.requests_from_lineitem(spark.read.parquet(table_path(SF, "lineitem"))))
    assert out.count() == batch.count()
    assert out.where("n > 0").count() == batch.where(F.size("reasons") > 0).count()


def test_stream_model_scoring(spark, demand):
    feats = fe.serving_features(
        demand.select(
            F.col("date").alias("prediction_date"),
            (F.col("product_id") - 1000).alias("product_id"),
            "category_id",
            "store_id",
            F.col("historical_sales").cast("double").alias("historical_sales"),
            "price",
            "promotion_flag",
            "holiday_flag",
            "economic_index",
        )
    ).withColumn("target_demand", F.lit(1.0))
    cols = ["price", "promotion_flag", "day_of_week", "sales_lag_1", "store_category"]
    model = M.DemandModel(cols, "gbt", {"maxIter": 3, "maxDepth": 3}).fit(
        feats.join(demand.select(F.col("date").alias("prediction_date"), "store_id", "target_demand"),
                   ["prediction_date", "store_id"]).drop(feats.target_demand).limit(2000)
    )
    lines = S.read_lineitem_stream(spark, S.stream_glob(table_path(SF, "lineitem")))
    scored = S.run_available_now(S.score_stream(S.requests_from_lineitem(lines), model), "t-score")
    valid = S.serving_stream(S.requests_from_lineitem(spark.read.parquet(table_path(SF, "lineitem"))))
    assert scored.count() == valid.count() > 0
    assert scored.where(F.col("predicted_demand") < 0).count() == 0

"""Print the physical plans of the main operators (used for PLANS.md)."""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    from pyspark.sql import functions as F

    from logscan.operators import prepare as P
    from logscan.operators.score import rank_one_model
    from logscan.operators.uploads import latest_uploads
    from logscan.plans import queries as Q
    from logscan.plans.detect import detect
    from logscan.session import get_session
    from logscan.sources.logs import read_logs

    spark = get_session()
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    folder = tempfile.mkdtemp(prefix="plans-")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "64k")
    Q.logs_view(spark, sf).repartition(16).write.mode("overwrite").option("header", True).csv(folder)
    model = rank_one_model(768, Q.fixed_weight)
    shown = {
        "detect (M6) over a many-split CSV folder": detect(read_logs(spark, folder), model, 0.0014),
        "token_index (M1 + count)": Q.q_token_index(spark, sf),
        "latest_upload (U3)": latest_uploads(Q.upload_events(spark, sf).select("fileName", "uploadTime", "filePath")),
        "dedupe (P8)": Q.q_dedupe(spark, sf),
        "threshold_filter with a one-row table (P6)": P.threshold_filter(
            Q.embedding_errors(spark, sf), spark.createDataFrame([(0.01,)], "threshold double")),
        "top_k (P7)": P.top_k(Q.embedding_errors(spark, sf), 10, tie_break=["vec_id"]),
    }
    # the exact-percentile passes, as exact_quantiles builds them
    from logscan.operators import quantile as QT

    errs = Q.embedding_errors(spark, sf)
    base = errs.where(F.col("recon_error").isNotNull()).select(
        QT.sortable_key(F.col("recon_error")).alias("_k")).persist()
    shown["exact percentile, pass 0 (histogram of the top 16 key bits)"] = (
        base.groupBy(QT._digit(0).alias("_d")).agg(F.count(F.lit(1)).alias("_n"), F.min("_k"), F.max("_k")))
    wanted = spark.createDataFrame([(123,)], "_pre long")
    framed = base.withColumn("_pre", F.shiftrightunsigned("_k", 48)).join(F.broadcast(wanted), ["_pre"])
    shown["exact percentile, pass 1 (only the open prefixes, next 16 bits)"] = (
        framed.groupBy("_pre", QT._digit(1).alias("_d")).agg(F.count(F.lit(1)).alias("_n")))
    for title, df in shown.items():
        print(f"### {title}\n\n```")
        for line in df._jdf.queryExecution().executedPlan().toString().strip().splitlines():
            print(line if len(line) <= 140 else line[:137] + "...")
        print("```\n")


if __name__ == "__main__":
    main()

"""K-means customer groups over recency, frequency and amount."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURES = ["recency_days", "total_orders", "total_amount"]
IDS = ["fact_customer_behavior_key", "customer_key"]


def clustered(fact_customer_behavior: DataFrame, k: int = 4, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Customers with ``features`` (standardised measures) and ``cluster``, and the k ``centre``s.

    A customer without one of the measures takes no part in the fit and gets a NULL cluster.
    """
    measured = fact_customer_behavior.select(*IDS, *[F.col(c).cast("double").alias(c) for c in MEASURES])
    complete = F.lit(True)
    for c in MEASURES:
        complete = complete & F.col(c).isNotNull()
    spark = measured.sparkSession
    known = measured.filter(complete)
    shape = "cluster int, centre array<double>"
    if known.isEmpty():
        nothing = measured.withColumns({"features": F.lit(None).cast("array<double>"), "cluster": F.lit(None).cast("int")})
        return nothing, spark.createDataFrame([], shape)
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=MEASURES, outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
            KMeans(featuresCol="scaled", predictionCol="cluster", k=k, seed=seed),
        ]
    ).fit(known)
    placed = model.transform(known).select(*IDS, *MEASURES, vector_to_array("scaled").alias("features"), "cluster")
    centres = [(i, c.tolist()) for i, c in enumerate(model.stages[-1].clusterCenters())]
    return placed.unionByName(measured.filter(~complete), allowMissingColumns=True), spark.createDataFrame(centres, shape)


def customer_clusters(fact_customer_behavior: DataFrame, k: int = 4, seed: int = 42) -> DataFrame:
    """Cluster number 0..k-1 per customer, on standardised measures; same seed, same groups."""
    return clustered(fact_customer_behavior, k, seed)[0].select(*IDS, *MEASURES, "cluster")


def cluster_check(customers: DataFrame, centres: DataFrame, k: int) -> DataFrame:
    """One row: customers, distinct customers, clusters out of range, and customers with a nearer centre than their own.

    The k centres are one row of at most k arrays, so every customer is compared with all of them in place.
    """
    all_centres = centres.agg(F.collect_list("centre").alias("centres"))
    own = customers.join(F.broadcast(centres), "cluster", "left").join(F.broadcast(all_centres))

    def distance(centre):
        return F.aggregate(F.zip_with("features", centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)

    nearest = F.array_min(F.transform("centres", distance))
    return own.agg(
        F.count("*").alias("customers"),
        F.countDistinct("fact_customer_behavior_key").alias("distinct_customers"),
        F.count(F.when(~F.col("cluster").between(0, k - 1), 1)).alias("out_of_range"),
        F.count(F.when(distance(F.col("centre")) > nearest + 1e-9, 1)).alias("not_nearest"),
    )

"""Distributed models: fraud classifier and product recommender."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etalage.functions.columns import hash_bucket
from etalage.operators.fraud import confusion
from etalage.session import write_through

FEATURES = [
    "amount",
    "hour",
    "country_mismatch",
    "device_change",
    "attempts_10min",
    "failures_24h",
    "past_attempts",
    "past_failures",
    "past_amount",
]


def split(df: DataFrame, key: str) -> DataFrame:
    """70/15/15 by a hash of the key: the same rows in every run."""
    b = hash_bucket(key)
    return df.withColumn(
        "part", F.when(b < 70, "train").when(b < 85, "validation").otherwise("test")
    )


def fit_fraud_model(
    features: DataFrame, label: str = "is_fraudulent", key: str = "payment_id", seed: int = 7
) -> tuple[RandomForestClassificationModel, DataFrame]:
    """A forest with classes weighted by their rarity; returns it with the scored rows."""
    numeric = features.select(
        key, F.col(label).cast("double").alias("label"), *[F.col(c).cast("double") for c in FEATURES]
    )
    # The trainer passes over the rows many times: keep them as a table.
    rows = write_through(split(numeric, key), "features")
    counts = rows.where("part = 'train'").agg(
        F.count("*").alias("n"), F.sum("label").alias("bad")
    ).first()
    bad = max(counts["bad"] or 0.0, 1.0)
    good = max(counts["n"] - bad, 1.0)
    weight = F.when(F.col("label") == 1, counts["n"] / (2 * bad)).otherwise(counts["n"] / (2 * good))
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        rows.withColumn("weight", weight)
    )
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", numTrees=20, maxDepth=5, seed=seed
    )
    model = forest.fit(ready.where("part = 'train'"))
    scored = model.transform(ready).select(
        key, "part", "label", vector_to_array("probability")[1].alias("score")
    )
    return model, scored


def threshold_metrics(scored: DataFrame, thresholds: list[float]) -> DataFrame:
    """Confusion counts, precision, recall and F1 per part and threshold, in one pass."""
    tests = {t: F.col("score") >= t for t in thresholds}
    return confusion(scored, "threshold", tests, F.col("label") == 1, by=["part"])


def recommend(
    bought: DataFrame, products: DataFrame, n: int = 3, per_category: int = 10, rank: int = 8, seed: int = 7
) -> DataFrame:
    """Best ``n`` products per customer among the most bought of the categories they buy, not yet theirs.

    ``bought`` is (customer_id, product_id, times). A customer has at most ``per_category`` candidates for
    each category they have bought from; the factors rank them. Ids must fit the trainer's 32 bits.
    """
    ratings = write_through(
        bought.select(
            F.col("customer_id").cast("int"), F.col("product_id").cast("int"), F.col("times").cast("float")
        ),
        "ratings",
    )
    als = ALS(
        userCol="customer_id",
        itemCol="product_id",
        ratingCol="times",
        implicitPrefs=True,
        rank=rank,
        maxIter=5,
        seed=seed,
        coldStartStrategy="drop",
    )
    return best_new(als.fit(ratings), ratings, products, n, per_category)


def best_new(model: ALSModel, ratings: DataFrame, products: DataFrame, n: int, per_category: int) -> DataFrame:
    """The candidates of :func:`recommend`, by the scores of the model.

    Customers move, not candidates: a customer's categories, factors and the leaders that are theirs already come together in one
    row, and what is left of each category's leaders is scored there; the best ``n`` of a category are rows again.
    """
    kinds = products.select(F.col("product_id").cast("int").alias("product_id"), "category")
    # Added up per product before the category is known: the windows below see one row a product.
    sold = ratings.groupBy("product_id").agg(F.sum("times").alias("sold")).join(kinds, "product_id")
    top = Window.partitionBy("category").orderBy(F.col("sold").desc(), "product_id")
    leaders = sold.withColumn("_rn", F.row_number().over(top)).where(F.col("_rn") <= per_category)
    factors = model.itemFactors.select(F.col("id").alias("product_id"), F.col("features").alias("item"))
    leaders = write_through(leaders.join(factors, "product_id").select("category", "product_id", "item"), "leaders")
    leading = leaders.select(F.col("product_id").alias("own")).distinct()
    seen = (
        ratings.join(kinds, "product_id", "left")
        .join(leading, F.col("product_id") == F.col("own"), "left")
        .groupBy("customer_id")
        .agg(F.collect_set("category").alias("categories"), F.collect_set("own").alias("own"))
    )
    users = model.userFactors.select(F.col("id").alias("customer_id"), F.col("features").alias("user"))
    interests = seen.join(users, "customer_id").select("customer_id", "own", "user", F.explode("categories").alias("category"))
    lists = leaders.groupBy("category").agg(F.collect_list(F.struct("product_id", "item")).alias("leaders"))

    def scored(leader: Column) -> Column:
        # What the model's own transform adds up, in its order and precision.
        products = F.zip_with("user", leader["item"], lambda a, b: a * b)
        score = F.aggregate(products, F.lit(0.0).cast("float"), lambda total, x: total + x)
        return F.struct((-score).alias("down"), leader["product_id"].alias("product_id"))

    fresh = F.filter("leaders", lambda leader: ~F.array_contains("own", leader["product_id"]))
    ranked = F.array_sort(F.filter(F.transform(fresh, scored), lambda x: ~F.isnan(x["down"])))
    candidates = interests.join(lists, "category").select("customer_id", F.inline(F.slice(ranked, 1, n)))
    best = Window.partitionBy("customer_id").orderBy("down", "product_id")
    return (
        candidates.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= n)
        .select("customer_id", "rank", "product_id", (-F.col("down")).alias("prediction"))
    )

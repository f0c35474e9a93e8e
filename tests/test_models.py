import random

from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from etalage.domain import Shop
from etalage.operators import fraud, ml
from etalage.plans.fraud import features
from etalage.sources import files, streams

SF = "/root/testdata/sf0.01"


def test_fraud_model_finds_most_frauds(spark):
    """The label hangs on the amount, which the forest sees; the parts share no payment."""
    model, scored = ml.fit_fraud_model(features(Shop(spark, SF)))
    scored = scored.persist()
    assert scored.count() == scored.select("payment_id").distinct().count()
    metrics = {(r.part, r.threshold): r for r in ml.threshold_metrics(scored, [0.5]).collect()}
    assert set(p for p, _ in metrics) == {"train", "validation", "test"}
    assert metrics["test", 0.5].recall > 0.5
    assert metrics["test", 0.5].precision > 0.3
    assert model.numFeatures == len(ml.FEATURES)


def test_recommendations_are_new_to_the_customer(spark):
    shop = Shop(spark, "/root/testdata/sf0.001")
    bought = (
        shop.lines.join(shop.orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id", "product_id")
        .agg(F.count("*").alias("times"))
    )
    best = ml.recommend(bought, shop.products, n=2).persist()
    assert best.count() > 0
    assert best.groupBy("customer_id").count().agg(F.max("count")).first()[0] <= 2
    assert best.join(bought, ["customer_id", "product_id"], "left_semi").count() == 0


def test_fraud_model_by_recount_and_against_the_rules(spark):
    """The table of thresholds is what a recount of the scores gives; on rows it has not seen the forest is better than any
    single rule, and scores frauds above others nine times in ten."""
    shop = Shop(spark, SF)
    _, scored = ml.fit_fraud_model(features(shop))
    rows = scored.collect()
    for t in (0.1, 0.3, 0.5, 0.9):
        for r in ml.threshold_metrics(scored, [t]).collect():
            own = [x for x in rows if x.part == r.part]
            hit = [x for x in own if x.score >= t]
            tp = sum(x.label for x in hit)
            assert (r.tp, r.fp) == (tp, len(hit) - tp)
            assert (r.fn, r.tn) == (sum(x.label for x in own) - tp, sum(1 - x.label for x in own) - len(hit) + tp)
    test = [x for x in rows if x.part == "test"]
    bad, good = ([x.score for x in test if x.label == y] for y in (1, 0))
    above = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert above > 0.9
    best = max(r.f1 for r in ml.threshold_metrics(scored, [0.1 * i for i in range(1, 10)]).where("part = 'test'").collect())
    flagged = shop.flagged.join(scored.where("part = 'test'").select("payment_id"), "payment_id")
    assert best > max(r.f1 for r in fraud.rule_metrics(fraud.score(flagged), []).collect())


def test_recommendations_follow_the_taste_of_alike_customers(spark):
    """Two circles buy from their own halves of one category; what is recommended is of the customer's own half."""
    draw = random.Random(6)
    bought = [(c, p, 2) for c in range(60) for p in draw.sample(range(12 * (c % 2), 12 * (c % 2) + 12), 7)]
    products = spark.createDataFrame([(p, "one") for p in range(24)], "product_id long, category string")
    best = ml.recommend(spark.createDataFrame(bought, "customer_id long, product_id long, times long"), products, n=3, per_category=24).collect()
    assert {r.customer_id for r in best} == set(range(60))
    own = sum(r.product_id // 12 == r.customer_id % 2 for r in best) / len(best)
    assert own > 0.95
    assert all(sorted(r.rank for r in best if r.customer_id == c) == [1, 2, 3] for c in range(60))


def test_recommendations_by_the_model_s_own_scores(spark):
    """All candidates listed and scored by the model give the same; a customer who has bought all leaders gets nothing."""
    draw = random.Random(3)
    bought = [(c, p, float(draw.randrange(1, 4))) for c in range(30) for p in draw.sample(range(24), 6)] + [(99, p, 9.0) for p in range(24)]
    ratings = spark.createDataFrame(bought, "customer_id int, product_id int, times float").persist()
    kind = {p: "abc"[p % 3] if p else None for p in range(24)}
    products = spark.createDataFrame(list(kind.items()), "product_id long, category string")
    als = ALS(userCol="customer_id", itemCol="product_id", ratingCol="times", implicitPrefs=True, rank=4, maxIter=2, seed=1)
    model = als.fit(ratings)
    sold, own = {}, {}
    for c, p, times in bought:
        sold[p] = sold.get(p, 0) + times
        own.setdefault(c, set()).add(p)
    leaders = {k: sorted((p for p in kind if kind[p] == k), key=lambda p: (-sold[p], p))[:5] for k in "abc"}
    pairs = [(c, p) for c, mine in own.items() for k in {kind[p] for p in mine if kind[p]} for p in leaders[k] if p not in mine]
    scores = {(r.customer_id, r.product_id): r.prediction for r in model.transform(spark.createDataFrame(pairs, "customer_id int, product_id int")).collect()}
    want = set()
    for c in own:
        mine = sorted((-scores[c, p], p) for x, p in pairs if x == c)
        want |= {(c, rank, p, -down) for rank, (down, p) in enumerate(mine[:3], 1)}
    got = ml.best_new(model, ratings, products, 3, 5)
    assert {tuple(r) for r in got.collect()} == want and 99 not in {c for c, *_ in want}
    # Ratings by product and by customer, products, factors: no candidate is joined with what is bought.
    assert "LeftAnti" not in got._jdf.queryExecution().toString()


def test_other_formats_are_read_and_written(spark, tmp_path):
    """Formats that need no jar stand for those that do."""
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    for kind, options in (("json", {}), ("csv", {"header": "true"})):
        path = str(tmp_path / kind)
        files.write_external(df, kind, path=path, **options)
        files.write_external(df, kind, path=path, **options)
        back = files.read_external(spark, kind, path=path, **options)
        assert back.select(F.col("id").cast("long")).agg(F.sum("id")).first()[0] == 6
    stream = streams.external_stream(spark, "rate", rowsPerSecond="1")
    assert stream.isStreaming and [f.name for f in stream.schema] == ["timestamp", "value"]

"""Models of a grid are whole."""

from pyspark.sql import functions as F

from retrospect.operators import models


def test_machines_of_a_grid_need_no_training_rows_to_score(spark):
    """They have learned their probabilities; their importances are those of a machine that hasn't."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for rows in batches:
            made.add(len(rows))
            yield rows

    plain = spark.range(0, 2_000, 1, 4).select("id", (F.col("id") * 7919 % 1000 / 100).alias("x"), (F.col("id") * 104729 % 997 / 100).alias("y"))
    plain = plain.withColumn("outcome", (F.col("x") + F.col("y") / 4 > 6).cast("int"))
    ((features, _, _, model),) = models.fit_grid(plain.mapInPandas(count, plain.schema), [["x", "y"]], {"svm": {}})
    assert made.value == 2_000
    scored = model.score(models.vectors(plain, features))
    assert made.value == 2_000 and model.calibration is not None
    assert scored.filter("score < 0 or score > 1 or (score > 0.5) <> (pred = 1)").isEmpty()
    assert models.importances(model, 2) == models.importances(models.fit("svm", models.vectors(plain, features)), 2)

import inspect

from pyspark.sql import functions as F

from furrow.operators import models


def test_boosting_has_the_surveys_settings():
    p = inspect.signature(models.impute_by_boosting).parameters
    assert (p["trees"].default, p["rate"].default, p["depth"].default) == (400, 0.05, 5)


def test_archetypes_keep_the_likeliest_of_three_starts(spark, monkeypatch):
    fits, fit = [], models.GaussianMixture.fit

    def counted(self, df):
        fits.append(fit(self, df))
        return fits[-1]

    monkeypatch.setattr(models.GaussianMixture, "fit", counted)
    df = spark.range(200).select("id", (F.col("id") % 4 + F.rand(1) / 4).alias("a"), F.rand(2).alias("b"))
    assert models.archetypes(df, "id", ["a", "b"]).count() == 200
    assert len(fits) == 3

"""Queries without SQL cover all their rows and use the operators' own limits."""

import pytest
from pyspark.sql import functions as F

from fieldspark.operators import models
from fieldspark.plans import QUERIES
from fieldspark.plans.series import full
from fieldspark.sources import views

SF = "/root/testdata/sf0.001"


def test_imputation_covers_all_station_days(spark):
    days = full(spark, SF)
    out = QUERIES["m2_impute_from_peers"](spark, SF).cache()
    assert out.count() == days.count() and out.exceptAll(out.dropDuplicates(["basin", "station", "date"])).isEmpty()
    key = ["basin", "station", "date"]
    assert days.select(key).exceptAll(out.select(key)).isEmpty()
    both = out.join(days.select(*key, F.col("value").alias("was")), key)
    assert both.where("was IS NOT NULL AND (imputed OR value <> was) OR imputed <> (was IS NULL AND value IS NOT NULL)").isEmpty()
    filled = out.where("imputed").agg(F.count_if(F.day("date") != 1).alias("later"), F.count_if(F.col("date") < "1999-01-01").alias("early")).first()
    assert filled.later > 0 and filled.early > 0


def test_selection_holds_out_every_survey(spark):
    keys = ["basin", "band", "date"]
    out = QUERIES["m5_m7_loyo_selection"](spark, SF).select(keys)
    surveys = views.labels(spark, SF).select(keys)
    assert out.exceptAll(surveys).isEmpty() and surveys.exceptAll(out).isEmpty()


@pytest.mark.parametrize("name", ["m5_m7_loyo_selection", "a29_fold_stations", "m8_m9_best_subset", "m12_m15_predict_days"])
def test_searches_have_no_limit_of_their_own(spark, monkeypatch, name):
    seen = []
    for f in ("loyo_select", "best_subset"):
        monkeypatch.setattr(models, f, lambda *a, f=getattr(models, f), **k: seen.append(k) or f(*a, **k))
    QUERIES[name](spark, SF)
    assert seen and not any("most" in k for k in seen)

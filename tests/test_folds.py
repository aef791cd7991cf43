"""Features as they were known at the end of each fold's training days."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark.models import shock as sk
from riskspark.operators import features as fe

DAYS = [dt.date(2021, 1, 1) + dt.timedelta(days=i) for i in range(60)]
UNTIL = {0: DAYS[19], 2: DAYS[39]}


@pytest.fixture(scope="module")
def raw():
    rng = np.random.default_rng(8)
    t = pd.DataFrame({"domain": np.repeat(["g", "h"], 60), "date": DAYS * 2, "a": rng.normal(size=120)})
    t.loc[3, "a"] = np.nan
    t["flat"] = np.where(t["date"] <= DAYS[19], 5.0, t["a"].fillna(0.0))
    return t


def frame(spark, t):
    return spark.createDataFrame(t).replace(float("nan"), None)


def test_z_scores_use_the_days_up_to_the_cutoff(spark, raw):
    got = fe.standardise_at(frame(spark, raw), ["domain"], ["a", "flat"], UNTIL).toPandas()
    assert len(got) == 240 and set(got["fold"]) == {0, 2}
    got = got.set_index(["fold", "domain", "date"]).sort_index()
    for k, day in UNTIL.items():
        for g, part in raw.groupby("domain"):
            past = part[part["date"] <= day]["a"]
            want = ((part["a"] - past.mean()) / past.std()).to_numpy()
            assert np.allclose(got.loc[(k, g), "z_a"].to_numpy(dtype=float), want, equal_nan=True)
    assert (got.loc[0, "z_flat"] == 0).all()          # constant until the cutoff
    assert got.loc[2, "z_flat"].abs().max() > 0


def test_a_changed_future_changes_no_earlier_row(spark, raw):
    later = raw.assign(a=np.where(raw["date"] > DAYS[19], raw["a"] * 9 + 4, raw["a"]))
    z = lambda t: fe.standardise_at(frame(spark, t), ["domain"], ["a"], UNTIL).filter(
        (F.col("fold") == 0) & (F.col("date") <= DAYS[19])).select("domain", "date", "z_a").orderBy(
        "domain", "date").toPandas()
    pd.testing.assert_frame_equal(z(raw), z(later))


def test_walk_forward_asks_for_its_cutoffs(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=60)
    t = pd.DataFrame({"series": "all", "date": DAYS, "label": (x > 0).astype(float), "f": x})
    rows, asked = spark.createDataFrame(t), {}

    def frame_at(until):
        asked.update(until)
        each = F.explode(F.array(*[F.lit(k) for k in until]))
        return rows.select(each.alias("fold"), "date", "f")

    got = sk.walk_forward(rows, folds=3, trees=5, features=["f"], frame_at=frame_at).toPandas()
    assert asked == {0: DAYS[14], 1: DAYS[29], 2: DAYS[44]}
    assert len(got) == 45 and all(got.loc[got["fold"] == k, "date"].min() > day for k, day in asked.items())
    assert ((got["p"] > 0.5) == (got["label"] == 1)).mean() > 0.9


def test_fold_models_do_not_depend_on_the_kind_of_join(spark):
    rng = np.random.default_rng(5)
    t = pd.DataFrame({"series": "all", "date": DAYS, "label": rng.integers(0, 2, 60).astype(float),
                      "f": rng.normal(size=60)})
    rows = spark.createDataFrame(t)

    def scores(hint):
        frame_at = lambda until: rows.select(F.explode(F.array(*[F.lit(k) for k in until])).alias("fold"), "date", "f").hint(hint)
        got = sk.walk_forward(rows, folds=3, trees=5, features=["f"], frame_at=frame_at)
        return got.select("fold", "date", "p").toPandas().sort_values(["fold", "date"], ignore_index=True)

    want = scores("broadcast")
    assert want["p"].nunique() > 3
    for hint in ("merge", "shuffle_hash"):
        pd.testing.assert_frame_equal(scores(hint), want)

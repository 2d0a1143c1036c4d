"""TEOS-10 at the check values that its authors publish (six samples of a cast, latitude 4)."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hydroframe.functions import teos

SA = [34.7118, 34.8915, 35.0256, 34.8472, 34.7366, 34.7324]
T = [28.7856, 28.4329, 22.8103, 10.2600, 6.8863, 4.4036]
CT = [28.8099, 28.4392, 22.7862, 10.2262, 6.8272, 4.3236]
P = [10.0, 50.0, 125.0, 250.0, 600.0, 1000.0]


@pytest.fixture(scope="module")
def cast(spark):
    return spark.createDataFrame(list(zip(range(6), SA, T, CT, P, strict=True)), "n int, sa double, t double, ct double, p double")


def values(df, c):
    return [r[0] for r in df.orderBy("n").select(c.alias("v")).collect()]


def test_temperatures(cast):
    c = F.col
    np.testing.assert_allclose(values(cast, teos.conservative_temperature(c("sa"), c("t"), c("p"))), [28.809919826700281, 28.439227816091140, 22.786176893078498, 10.226189266620782, 6.827213633479988, 4.323575748610455], atol=1e-9)
    np.testing.assert_allclose(values(cast, teos.potential_temperature(c("sa"), c("t"), c("p"))), [28.783196819670632, 28.420983342398962, 22.784930399117108, 10.230523661095731, 6.829230224409661, 4.324510571845719], atol=1e-9)


def test_volume_and_sound(cast):
    c = F.col
    np.testing.assert_allclose(values(cast, teos.specific_volume(c("sa"), c("ct"), c("p"))), 1e-3 * np.array([0.978626852431313, 0.978222365701325, 0.976155264597929, 0.972961258011157, 0.971026719344908, 0.968989944622149]), rtol=1e-12)
    np.testing.assert_allclose(values(cast, teos.density(c("sa"), c("ct"), c("p"))), [1021.839935738108, 1022.262457966867, 1024.427195413316, 1027.790152759127, 1029.837779000189, 1032.002453224572], rtol=1e-12)
    np.testing.assert_allclose(values(cast, teos.sound_speed(c("sa"), c("t"), c("p"))), [1542.615803587414, 1542.703534065789, 1530.844979136360, 1494.409996920661, 1487.377102518027, 1483.934609078705], rtol=1e-9)


def test_height_and_stability(cast):
    c, w = F.col, Window.partitionBy(F.lit(1)).orderBy("p")
    np.testing.assert_allclose(values(cast, teos.height(c("p"), F.lit(4.0))), [-9.9445834469453, -49.7180897012550, -124.2726219409978, -248.4700576548589, -595.8253480356214, -992.0919060719987], rtol=1e-10)
    df = cast.withColumns({f"n_{x}": F.lead(x).over(w) for x in ("sa", "ct", "p")})
    found = values(df, teos.n_squared(c("sa"), c("ct"), c("p"), c("n_sa"), c("n_ct"), c("n_p"), F.lit(4.0)))
    np.testing.assert_allclose(found[:5], 1e-3 * np.array([0.060843209693499, 0.235723066151305, 0.216599928330380, 0.012941204313372, 0.008434782795209]), rtol=1e-8)
    assert found[5] is None


def test_sql_text_is_the_same_polynomial():
    import duckdb

    text = teos.nested_sql(teos.V, ["x", "y", "z"])
    ((got,),) = duckdb.sql(f"select {text} from (select 1.2::double as x, 0.4::double as y, 0.05::double as z)").fetchall()
    assert abs(got - teos.nested(teos.V, [1.2, 0.4, 0.05])) < 1e-17
    assert len(teos.V) == 75


def test_nulls_and_fresh_water(spark):
    row = spark.range(1).select(
        teos.conservative_temperature(F.lit(None).cast("double"), F.lit(1.0), F.lit(2.0)).alias("a"), teos.density(F.lit(-1.0), F.lit(4.0), F.lit(0.0)).alias("b"),
        teos.density(F.lit(0.0), F.lit(4.0), F.lit(0.0)).alias("c"),
    ).first()
    assert row["a"] is None and row["b"] == row["c"] and abs(row["b"] - 999.97) < 0.1

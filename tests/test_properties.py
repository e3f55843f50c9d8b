"""Property test: skew-safe running sums equal pandas cumulative sums for
random groups (with nulls), orders, slice counts and directions."""
import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators.prefix import running_sums


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 300), groups=st.integers(1, 6), slices=st.integers(1, 12), desc=st.booleans(),
       seed=st.integers(0, 10_000))
def test_running_sums_property(spark, n, groups, slices, desc, seed):
    rng = np.random.default_rng(seed)
    g = rng.integers(0, groups, n).astype(float)
    g[rng.random(n) < 0.1] = np.nan                       # null group keys stay a group
    pdf = pd.DataFrame({"id": np.arange(n, dtype="int64"), "g": g, "t": rng.integers(0, 20, n).astype("int64"),
                        "v": rng.integers(-5, 10, n).astype("int64")})
    df = spark.createDataFrame(pdf.astype({"g": "Int64"}).astype(object).where(pdf.notna(), None),
                               "id long, g long, t long, v long")
    order = [("t", "desc") if desc else "t", "id"]
    out = running_sums(df, order, ["v"], groups=["g"], slices=slices, totals=True).toPandas()
    e = pdf.assign(gk=pdf["g"].fillna(-1)).sort_values(["gk", "t", "id"], ascending=[True, not desc, True])
    e["cum"] = e.groupby("gk")["v"].cumsum()
    e["tot"] = e.groupby("gk")["v"].transform("sum")
    m = out.merge(e[["id", "cum", "tot"]], on="id")
    assert len(m) == n
    assert (m["cum_v"] == m["cum"]).all() and (m["tot_v"] == m["tot"]).all()

"""Property tests (hypothesis) for the quota allocation and the rank helper."""

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from tabsieve.functions import ranks
from tabsieve.operators.split import allocate


@given(st.dictionaries(st.integers(0, 20), st.integers(0, 10_000), min_size=1, max_size=8),
       st.floats(0, 1))
def test_allocate_sums_and_stays_proportional(counts, frac):
    n = sum(counts.values())
    total = int(n * frac)
    q = allocate(counts, total)
    assert sum(q.values()) == total
    for k, v in counts.items():
        assert 0 <= q[k] <= v
        assert abs(q[k] - total * v / n) < 1 if n else q[k] == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, values):
    pdf = pd.DataFrame({"x": [float(v) for v in values]})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.3, 0.5, 0.9, 1.0]
    got = {r["prob"]: r["quantile"] for r in ranks.exact_quantiles(df, ["x"], probs).collect()}
    for p in probs:
        assert abs(got[p] - np.quantile(pdf["x"], p)) < 1e-9

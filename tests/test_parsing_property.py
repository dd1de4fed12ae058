"""Numbers parsed from text agree with pandas.to_numeric(errors='coerce').

Plain decimals (signs, blanks, dots, junk) must agree exactly. With an exponent, pandas' own fast
parser is not correctly rounded for large exponents (e.g. '5e29') and turns '0e999' into a missing
value; Spark returns the correctly rounded double. So exponent forms are generated where both are
exact: small integer mantissa, exponent 0-9.
"""

from __future__ import annotations

import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roomledger.functions.parsing import to_double

plain = st.text(alphabet="0123456789.+- ", min_size=1, max_size=8)
exponent = st.builds(
    lambda m, e, sign, case: f"{sign}{m}{case}{e}",
    st.integers(0, 999), st.integers(0, 9), st.sampled_from(["", "+", "-"]), st.sampled_from(["e", "E"]),
)


def pandas_values(texts: list[str]) -> list:
    values = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce")
    return [None if (v is None or math.isnan(v) or math.isinf(v)) else float(v) for v in values]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.one_of(plain, exponent), min_size=100, max_size=400, unique=True))
def test_to_double_matches_pandas(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = {r.s: r.v for r in df.select("s", to_double(F.col("s")).alias("v")).collect()}
    mismatches = [(t, got[t], w) for t, w in zip(texts, pandas_values(texts)) if got[t] != w]
    assert not mismatches, mismatches[:5]

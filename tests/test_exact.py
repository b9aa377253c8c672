from decimal import Decimal
from fractions import Fraction

from helpers import half_away
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketbars.functions import exact


def test_ties_go_away_from_zero(spark):
    rows = [(1, 2), (-1, 2), (3, 2), (-3, 2), (1, 3), (-1, 3), (0, 5), (5, 0), (7, -2)]
    got = spark.createDataFrame(rows, "n bigint, d bigint").select(
        exact.rounded_quotient(F.col("n"), F.col("d")).alias("q")
    )
    assert [r.q for r in got.collect()] == [1, -1, 2, -2, 0, 0, 0, None, -4]


def test_pct_change_edges(spark):
    rows = [("200.00", "199.99"), ("0.00", "5.00"), (None, "5.00"), ("0.01", "99999999.99")]
    frame = spark.createDataFrame(rows, "b string, c string").select(
        exact.pct_change(
            F.col("c").cast("decimal(10,2)"), F.col("b").cast("decimal(10,2)")
        ).alias("pct")
    )
    # Half a hundredth rounds away from zero; zero base and out-of-range give NULL.
    assert [r.pct for r in frame.collect()] == [
            Decimal("-0.01"),
            None,
            None,
            Decimal("999999999800.00"),
        ]


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(st.integers(-(10**12), 10**12), st.integers(1, 10**6)), min_size=1, max_size=30
    )
)
def test_quotient_matches_fractions(spark, pairs):
    got = (
        spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, n bigint, d bigint")
        .select("i", exact.rounded_quotient(F.col("n") * 100, F.col("d")).alias("q"))
        .orderBy("i")
    )
    expected = [int(half_away(Fraction(n, d)) * 100) for n, d in pairs]
    assert [r.q for r in got.collect()] == expected

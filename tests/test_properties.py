"""Property tests over generated values (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cloakline.functions.crypto import has_text
from cloakline.operators.table import pseudonymize, reidentify

# Whitespace and separators (Unicode White_Space, U+001C..U+001F, U+0085) mixed with other text, no surrogates.
SPACES = st.sampled_from([" ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0",
                          "\u2000", "\u2028", "\u3000", "\u200b", "\ufeff"])
CHARS = st.one_of(SPACES, st.characters(blacklist_categories=("Cs",)))
VALUES = st.lists(st.one_of(st.none(), st.text(CHARS, max_size=40)), min_size=1, max_size=30)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=VALUES)
def test_roundtrip_and_blank_rule(spark, kr, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
    # The column form of the blank rule agrees with Python's str.strip (the reference's rule).
    flags = {r.id: r.t for r in df.select("id", has_text(F.col("v")).alias("t")).collect()}
    for i, v in enumerate(values):
        assert flags[i] == (None if v is None else v.strip() != ""), repr(v)
    want = {i: (None if v is None else v if v.strip() else "") for i, v in enumerate(values)}
    for strategy in ("row", "distinct"):
        p = pseudonymize(df, "v", kr, strategy=strategy)
        back = {r.id: r.v for r in reidentify(p, "v", kr, strategy=strategy).collect()}
        assert back == want, strategy

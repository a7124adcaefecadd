from collections import Counter

import pytest

from checkmart.operators import quality


@pytest.fixture(scope="module")
def bad(spark):
    return spark.createDataFrame(
        [(1, "pickup"), (1, "kiosk"), (2, "kiosk"), (None, None), (None, "tent"), (3, "other")],
        "id long, channel string",
    )


@pytest.fixture(scope="module")
def clean(spark):
    return spark.createDataFrame([(1, "pickup"), (2, "other")], "id long, channel string")


SUITE = [
    quality.Check("t", "id", "not_null"),
    quality.Check("t", "channel", "not_null"),
    quality.Check("t", "id", "unique"),
    quality.Check("t", "channel", "accepted_values", quality.CHANNELS),
    quality.Check("t", "id", "relationship", to_table="u"),
    quality.Check("elsewhere", "id", "unique"),
]


def test_single_checks(bad):
    nulls = {r.column_name: r.failures for r in quality.not_null(bad, ["id", "channel"]).collect()}
    assert nulls == {"id": 2, "channel": 1}
    assert [tuple(r) for r in quality.unique(bad, "id").collect()] == [(1, 2)]
    strange = {r.channel: r.rows_count for r in quality.accepted_values(bad, "channel", quality.CHANNELS).collect()}
    assert strange == {"kiosk": 2, "tent": 1}


def test_report(bad, clean):
    report = quality.dq_report({"t": bad, "u": clean}, SUITE)
    failures = {(r.column_name, r.test): r.failures for r in report.collect()}
    assert failures == {
        ("id", "not_null"): 2,
        ("channel", "not_null"): 1,
        ("id", "unique"): 1,
        ("channel", "accepted_values"): 2,
        ("id", "relationship"): 1,
    }
    with pytest.raises(ValueError, match=r"t\.channel accepted_values: 2"):
        quality.require_clean(report)
    quality.require_clean(quality.dq_report({"t": clean}, SUITE[:4]))


def test_declared_suite():
    assert Counter(c.test for c in quality.CHECK_SUITE) == {"not_null": 24, "unique": 9, "accepted_values": 3}
    assert len({c.table for c in quality.CHECK_SUITE}) == 12

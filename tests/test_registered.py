"""Every registered query of the reference's operators against its SQL."""

import pytest

from tests.oracle import SMALL, differ

plans = pytest.importorskip("tessera.plans.registry")


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, name):
    df = plans.QUERIES[name](spark, SMALL)
    if name in plans.ORACLES:
        assert differ(df, plans.ORACLES[name], SMALL) == ""
    else:
        assert df.count() >= 0

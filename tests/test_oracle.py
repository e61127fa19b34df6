"""Every registered query against its independent DuckDB statement.

Runs on sf0.001, where the hourly series has gaps (row-based windows must
still match the SQL window functions).  ``tests/oracle_compare.py`` runs the
same comparison at any scale.
"""

import pytest

from scales import SF_SMALL
from oracle_compare import compare
from stratus.catalog import ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)
    assert res[name] == "ok", res[name]

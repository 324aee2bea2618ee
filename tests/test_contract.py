"""Driver contract: every registered query keeps one schema across scale factors."""

import pytest

import __spark_entry__ as entry

from .conftest import SF_MID, SF_SMALL

KEYS = sorted(k for k in entry.queries() if not k.startswith("model_"))


@pytest.mark.parametrize("key", KEYS)
def test_schema_is_stable_across_scale(spark, key):
    q = entry.queries()[key]
    assert q(spark, SF_SMALL).schema == q(spark, SF_MID).schema

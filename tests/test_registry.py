import datetime

import pytest

from lakeloom.operators import registry

T = datetime.datetime


def test_promote_and_rollback(spark):
    log = registry.promote(spark, "fare", 1, at=T(2024, 1, 1)).unionByName(
        registry.promote(spark, "fare", 2, at=T(2024, 2, 1)))
    assert registry.production_version(log, "fare") == 2
    assert registry.next_version(log, "fare") == 3
    log = log.unionByName(registry.rollback(log, "fare", 1, at=T(2024, 3, 1)))
    assert registry.production_version(log, "fare") == 1
    with pytest.raises(registry.NoProductionVersion):
        registry.rollback(log, "fare", 9)


def test_no_production_version_fails(spark):
    log = registry.event(spark, "fare", 1, registry.STAGING, "candidate", T(2024, 1, 1))
    with pytest.raises(registry.NoProductionVersion):
        registry.production_version(log, "fare")

"""Rewrites on seeded random frames where one postal code holds a third of all rows."""

import random
from decimal import Decimal

import pytest

from landlens.operators import aggregate, fanout, followup, joins
from tests.test_equivalence import groups_fixture, same_bag

ZONES = ["Residential", "Commercial", "Other", "Industrial", None]
AREAS = ["North", "South", "East", None]


def _skewed(spark, seed, n_tax=600, n_permits=900):
    rnd = random.Random(seed)
    hot = "HOT 1A1"

    def postal():
        return hot if rnd.random() < 1 / 3 else f"P{rnd.randint(0, 40):02d}"

    tax = [(str(i), postal(), rnd.choice(ZONES), rnd.choice(["Main", "Oak"]),
            Decimal(rnd.randint(0, 10**6)) / 100, Decimal(rnd.randint(0, 10**5)) / 100,
            None if rnd.random() < 0.05 else Decimal(rnd.randint(0, 10**4)) / 100,
            rnd.randint(2015, 2024)) for i in range(n_tax)]
    permits = [(postal() if rnd.random() > 0.02 else None, rnd.choice(AREAS)) for _ in range(n_permits)]
    t = spark.createDataFrame(tax, "PID string, PROPERTY_POSTAL_CODE string, ZONING_CLASSIFICATION string, "
                                   "STREET_NAME string, CURRENT_LAND_VALUE decimal(18,2), "
                                   "CURRENT_IMPROVEMENT_VALUE decimal(18,2), TAX_LEVY decimal(18,2), REPORT_YEAR int")
    p = spark.createDataFrame(permits, "POSTAL_CODE string, GEO_LOCAL_AREA string")
    return t, p


@pytest.mark.parametrize("seed", [1, 2])
def test_r1_under_skew(spark, seed):
    tax, permits = _skewed(spark, seed)
    for distinct in (False, True):
        a = fanout.property_tax_by_year_area(tax, permits, weighting="distinct" if distinct else "fanout")
        b = fanout.property_tax_by_year_area_naive(tax, permits, distinct=distinct)
        assert same_bag(a, b)
    assert fanout.bridge_row_count(tax, permits).first().total_rows == \
        fanout.postal_area_bridge(tax, permits).count()


@pytest.mark.parametrize("seed", [3])
def test_followup_under_skew(spark, seed):
    rnd = random.Random(seed)

    def postal():
        return "HOT 1A1" if rnd.random() < 1 / 3 else f"P{rnd.randint(0, 30):02d}"

    lic = {(postal(), rnd.randint(15, 24), rnd.choice(["Main", "Oak"]), rnd.choice(AREAS)): (rnd.randint(0, 9), rnd.randint(1, 3)) for _ in range(300)}
    tax = {(postal(), rnd.randint(2015, 2024), rnd.choice(ZONES), rnd.choice(["Main", "Oak"])): rnd.choice([None, 0, 100, 250]) for _ in range(300)}
    v1, v2 = groups_fixture(spark, [(*k, *v) for k, v in lic.items()], [(*k, v) for k, v in tax.items()])
    v3 = joins.combined_by_postal_code(v1, v2)
    ref = followup.investment_land_value_followup_naive(v3)
    for s in ("frame", "explode", "range"):
        assert same_bag(ref, followup.investment_land_value_followup(v1, v2, strategy=s)), s
    assert same_bag(aggregate.combined_by_local_area(v1, v2), aggregate.combined_by_local_area_naive(v3))

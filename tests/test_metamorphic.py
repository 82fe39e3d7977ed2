"""
partition counts give the same report; every score stays in its range."""

import os

import pytest

from entiscore.plans import report as R
from entiscore.plans.catalog import rounded, terms
from entiscore.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")


def _inputs(spark, shuffle=False):
    def prep(df):
        return df.repartition(7) if shuffle else df

    return (prep(fx.target(spark, SF)), prep(fx.gene_essentiality(spark, SF)), prep(fx.mouse_phenotypes(spark, SF)),
            prep(fx.molecule(spark, SF)), prep(fx.tissue_atlas(spark, SF)), prep(fx.mouse_phenotypes(spark, SF)),
            prep(fx.phenotype_scores(spark, SF)), *terms(spark, SF), fx.query_ids(spark, SF))


def _rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_report_invariant_to_partitioning(spark):
    base = _rows(rounded(R.priority_report(*_inputs(spark)), "phenotypeScores"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        reshuffled = _rows(rounded(R.priority_report(*_inputs(spark, shuffle=True)), "phenotypeScores"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert base == reshuffled


def test_report_score_ranges(spark):
    rep = R.priority_report(*_inputs(spark))
    ranges = {
        "isInMembrane": {0, 1}, "isSecreted": {0, 1}, "hasPocket": {0, 1}, "hasLigand": {0, 1},
        "hasSmallMoleculeBinder": {0, 1}, "hasSafetyEvent": {-1}, "isCancerDriverGene": {-1},
        "isEssential": {-1, 0}, "hasTEP": {1}, "hasMouseKO": {0, 1}, "hasHighQualityChemicalProbes": {0, 1},
    }
    graded = {"geneticConstraint": (-1, 1), "paralogMaxIdentityPercentage": (-1, 0),
              "mouseOrthologMaxIdentityPercentage": (0, 1), "maxClinicalTrialPhase": (0, 1),
              "tissueSpecificity": (-1, 1), "tissueDistribution": (-1, 1), "phenotypeScores": (-1, 0)}
    rows = rep.collect()
    assert rows
    for r in rows:
        for c, allowed in ranges.items():
            assert r[c] is None or r[c] in allowed, (c, r[c])
        for c, (lo, hi) in graded.items():
            assert r[c] is None or lo <= r[c] <= hi, (c, r[c])
    # "no information" stays distinct from zero: every measure has nulls and non-nulls
    for c in list(ranges) + list(graded):
        vals = [r[c] for r in rows]
        assert any(v is None for v in vals) and any(v is not None for v in vals), c

"""What homologation reads: each input once a step, not once for every join."""

import re

from fieldmart.operators import mdm
from fieldmart.plans import bed_mdm
from tests.conftest import DATA


def test_inputs_are_scanned_a_few_times(spark, monkeypatch):
    """The rows are read for their distinct values and again for the result; catalogue and dictionary once."""
    plans, homologate = [], mdm.homologate
    monkeypatch.setattr(mdm, "homologate", lambda *args, **kw: plans.append(homologate(*args, **kw)) or plans[-1])
    monkeypatch.setattr(type(spark.range(0)), "checkpoint", _noted(plans, type(spark.range(0)).checkpoint))
    query = next(q for n, q, _ in bed_mdm.bed.entries if n == "homologate")
    query(spark, DATA).count()
    scans = sum(len(re.findall(r"FileScan parquet", df._jdf.queryExecution().sparkPlan().toString())) for df in plans)
    assert 0 < scans <= 6


def _noted(plans, checkpoint):
    def run(df, *args, **kw):
        plans.append(df)
        return checkpoint(df, *args, **kw)

    return run

"""A crash holding a third of all rows must not land in one task (measured from Spark's event log)."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile

import pytest

from conftest import ROOT, SF_MEDIUM, SF_SMALL
from roadlens.plans.analyses import ANALYSES
from roadlens.plans.variants import VARIANTS


# Keys whose plans join, anti-join or window on crash_id: where a NULL key could pile up.
NULL_SENSITIVE = ["a02", "a03", "a04", "a05", "a07", "a08", "a09", "a10", "v_bottom_makes",
                  "v_no_damage_not_in", "v_non_female_pairs", "v_zip_dedup_first"]


@pytest.mark.parametrize("hot", ["copies", "distinct", "null"])
def test_no_task_reads_the_hot_crash(hot):
    """One crash (copies of a real one, or with different units), or the NULL crash_id, holds a third of the rows."""
    keys = NULL_SENSITIVE if hot == "null" else sorted({*ANALYSES, *VARIANTS})
    scratch = tempfile.mkdtemp(prefix="roadlens-skew-", dir="/tmp")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tests", "skew_probe.py"), f"--hot={hot}", SF_SMALL, scratch, *keys],
        capture_output=True, text=True, timeout=1500, check=True,
    ).stdout.strip().splitlines()[-1]
    report = json.loads(out)
    biggest = max(report["sizes"].values())
    hot_rows = biggest * report["hot_share"]
    worst = {k: v for k, v in report["max_task_shuffle_records"].items() if v > 0.45 * hot_rows}
    assert set(report["max_task_shuffle_records"]) == set(keys)
    assert not worst, f"tasks reading most of the hot crash: {worst} (hot crash ~{hot_rows:.0f} rows)"


def test_star_queries_spread_a_hot_key():
    """Each s_* key with a third of its table on one key and AQE's skew split off: no task reads most of that key's rows.

    s_topk / s_entities join raw lineitem rows on l_partkey and split off the hot key themselves; the rest collapse
    it by partial aggregation, a window group limit or a bounded broadcast.
    """
    scratch = tempfile.mkdtemp(prefix="roadlens-star-skew-", dir="/tmp")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tests", "star_skew_probe.py"), SF_MEDIUM, scratch, "off"],
        capture_output=True, text=True, timeout=1200, check=True,
    ).stdout.strip().splitlines()[-1]
    report = json.loads(out)["queries"]
    bad = {k: v for k, v in report.items() if v["max_task_shuffle_records"] > 0.45 * v["hot_rows"]}
    assert not bad, bad

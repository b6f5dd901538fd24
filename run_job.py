"""Batch job entry point: ``spark-submit run_job.py --config params.yml``.

The config names the four input tables and the ten output folders (see
``roadlens/plans/job.py``).  Only the driver imports ``roadlens``: the plans
use built-in expressions only, so no Python code runs on the executors and
nothing has to be shipped to them.
"""

import sys

from roadlens.plans.job import main

if __name__ == "__main__":
    sys.exit(main())

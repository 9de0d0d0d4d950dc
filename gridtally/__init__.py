"""Utility-metering analytics as Spark DataFrame operators.

``functions``  scalar column expressions (times, numbers, text, formulas)
``sources``    reading and table scans, batch and stream
``operators``  DataFrame -> DataFrame steps: cleaning, hourly use, rollups, ...
``streaming``  the live path on Structured Streaming
``plans``      the composite jobs (backfill, live batch)
"""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with the job, so executors do not need
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

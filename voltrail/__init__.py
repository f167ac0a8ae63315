"""Voltrail: vehicle telemetry jobs written as Spark DataFrame transforms."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Task functions travel inside the job, so executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])

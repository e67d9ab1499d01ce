"""Retrieval and vector analytics over DataFrames.

Collections are tables, queries are rows: every operator takes DataFrames and
returns a DataFrame, and a whole table of queries is answered by one job.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the plan, so executors do not
# need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"

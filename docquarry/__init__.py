"""Spark jobs for question answering over document collections.

Stages: elements -> clean text -> token chunks -> vectors -> keyed collections ->
top-k retrieval -> prompts and answers -> retrieval and answer reports.
Every stage takes and returns DataFrames.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job that uses them, so
# the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

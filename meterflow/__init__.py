"""Time-series analytics over entity-keyed measurement tables, as Spark jobs.

Every operator is a function from DataFrame to DataFrame. Nothing here keeps a
session, collects rows to the driver or moves a whole series into one task.
"""
import sys

from pyspark import cloudpickle

from .operators.layout import Series

# Functions that run in Python workers travel with the job: executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Series"]

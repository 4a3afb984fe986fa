"""Customer-activity analytics for retail banking, written as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from bankpulse.params import AnalysisParams
from bankpulse.tables import BankTables, FrameTables

__all__ = ["AnalysisParams", "BankTables", "FrameTables"]

# Functions of this package travel to the executors with the job: they need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

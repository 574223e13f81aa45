"""Survey analytics on Spark DataFrames.

Every operator takes DataFrames and returns DataFrames.  Work that grows with
the data stays in Spark; only tables whose size is bounded by the number of
columns (or by an explicit, checked limit) come back to the driver.
"""

import sys

from pyspark import cloudpickle

from tallyframe.spec import HEART_SURVEY, SurveySpec

__all__ = ["HEART_SURVEY", "SurveySpec"]

# Functions sent to Python workers take the library's code along, so executors need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

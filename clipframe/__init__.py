"""clipframe: labelled-audio datasets as Spark DataFrames.

Every operator takes a DataFrame and returns a DataFrame; column names are
parameters, so the same operator runs on folders of WAV files and on tables.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so a cluster
# needs no copy of the package on its executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"

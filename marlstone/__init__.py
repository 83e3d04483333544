"""Text retrieval, retrieval evaluation, medallion tables, property-graph
queries and personal-data scans as DataFrame-to-DataFrame functions on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers are sent as they are, so the package has
# to be installed on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

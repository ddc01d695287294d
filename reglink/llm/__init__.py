"""Operators for large training-data pipelines, one module per operator.

Nothing outside this subpackage imports it; ``queries.py`` holds the registered
queries, ``__spark_entry__.py`` adds them when the subpackage is present.

Functions that run in Python workers are shipped by value, so executors need the
libraries (numpy, pyarrow, ...) but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

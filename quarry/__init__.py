"""quarry: analytics and learning queries over retail tables, written as Spark DataFrame plans."""

import sys as _sys

__version__ = "0.1.0"

# The Arrow-batch kernels (token hash, wide-vector assignment) are functions of
# this package. Ship them to Python workers by value inside the task closures,
# so executors need NumPy and PyArrow but not an installed copy of the package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover - older pyspark
    pass

"""rectext: turn open-ended JSON records into labelled text features with Spark.

Every public function maps DataFrames to DataFrames using Spark's own
expressions (variant, higher-order functions, windows, dynamic partition
overwrite); nothing is collected to the driver except file listings.
"""

import sys as _sys

# Python functions this package hands to Spark (mapInPandas bodies, batch
# functions) are pickled by value, so executors need no installed copy of
# the package.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without by-value support
    pass

from rectext.session import get_spark, work_dir  # noqa: E402

__all__ = ["get_spark", "work_dir"]

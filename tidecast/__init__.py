"""tidecast: time-series features, forecasting, evaluation and hierarchical
reconciliation expressed as Spark DataFrame/SQL plans."""

import sys as _sys

__version__ = "0.1.0"

# Functions shipped to Python workers (pandas UDF bodies) are pickled by value,
# so executors need not have this package installed or on their path.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the API
    pass

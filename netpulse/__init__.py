"""Per-source network-log analytics on Spark: batch, streaming, forecast and regression."""

import sys as _sys

try:  # ship the package's functions to Python workers by value: executors need not have it installed
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the hook
    pass

"""eventide: keyed, ordered, stateful stream operators on Spark."""

import sys as _sys

# Python code that runs inside tasks (the pricing fold, the stream
# processors) is shipped with the task by value, so executors do not need
# this package installed or on their path.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

from eventide.operators import *  # noqa: E402,F401,F403
from eventide.session import get_session  # noqa: E402,F401

"""Operators of a training-data pipeline: each module is one operator, `queries` registers them.

Functions that run inside tasks are sent to the executors by value, so the
package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

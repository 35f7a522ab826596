"""Operators of a training-data pipeline; nothing else in the library imports this.

Functions that run in tasks travel with the job, so executors need no copy of this
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

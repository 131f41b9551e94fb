"""Operators that prepare text for training language models; ``registry`` has their queries.

Functions that run inside tasks are sent with them, so executors need the public libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

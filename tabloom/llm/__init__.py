"""Operators for preparing language-model training data.

Nothing outside this package imports it. Functions that run on executors travel with the job,
so executors need none of its files.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for training data at scale; nothing else in the library needs them.

Functions of this package that run in tasks travel with the job, so that
executors need numpy, pyarrow and the named tokenizer files, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for large training corpora: deduplication, language, personal data, packing, search.

Functions of this package are shipped to executors by value, so a session whose workers do not
have the repository on their path can run them too.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Python tasks carry the code that they call by
value, so executors need no copy of the package.
"""

import sys

from pyspark.cloudpickle.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])

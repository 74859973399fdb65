"""Training-data operators over ``documents``, ``benchmark`` and ``conversations``.

Nothing else in the library imports this subpackage. Every operator reads the columns it
names and ignores all others, so extra columns can't clash with its own.
"""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with them: executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

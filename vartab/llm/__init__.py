"""Training-data pipeline operators. Nothing else in the library imports this
package; ``__spark_entry__`` adds its queries when the package is present.

Python functions of this package travel to the executors by value, so these
need no copy of the library on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Functions of this package that run inside Spark tasks are shipped by value, so executors need no
copy of it on their import path.  What a task holds must then pickle by value too: no cached
functions of a module, no instances of the package's classes in a plain broadcast."""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

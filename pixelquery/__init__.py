"""pixelquery: land-cover analytics on gridded imagery, expressed as Spark DataFrame operators.

A raster is a DataFrame with one row per pixel: ``row INT, col INT`` plus one column per band.
Nodata is always NULL.  Every operator takes DataFrames and returns a DataFrame.
"""

import sys

from pyspark import cloudpickle

from pixelquery.grid import Grid

# ship the few Python task bodies with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Grid"]

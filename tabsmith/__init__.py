"""tabsmith: Spark-native operators for tabular machine-learning data work.

Every operator is a ``DataFrame -> DataFrame`` function or a fit/transform
pair whose fitted parameters are themselves DataFrames.  Sub-packages:

* ``sources``   - table/CSV/report/model/parameter readers and writers
* ``functions`` - ``Column`` expressions (scalars, dates, test statistics)
* ``operators`` - DataFrame operators (cleaning, encoders, drift, models ...)
* ``plans``     - composed plans used by the query catalogue
* ``streaming`` - running the quality suite on micro-batches
"""

from tabsmith.session import get_spark, scratch_dir  # noqa: F401

__version__ = "0.1.0"

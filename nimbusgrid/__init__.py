"""nimbusgrid: daily panel time series on Spark DataFrames.

Every operator is a plain ``DataFrame -> DataFrame`` function.  A *panel* holds one row per
(series, day); the default key names are ``indicativo`` and ``fecha``.
"""

SERIES = "indicativo"
DATE = "fecha"

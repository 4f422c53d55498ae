"""indicata: programme-indicator reporting operators on Spark DataFrames.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a Column
builder), so pipelines compose with ``df.transform``.  Business rules
(recodes, corrections, score bands, derived indicators, window anchors) are
data in :mod:`indicata.plans.rules`, passed to generic operators.
"""

__version__ = "0.1.0"

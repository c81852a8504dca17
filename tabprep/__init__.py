"""tabprep: Spark-native preparation, rebalancing and evaluation of binary
classification tables.

Every operator takes and returns DataFrames and stays lazy, except *fits*,
which run one small aggregate and turn its single row into literals for the
next lazy plan.
"""

from tabprep.session import get_spark, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"

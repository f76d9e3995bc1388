"""strata — a layered (bronze → silver → gold) warehouse on Spark DataFrames.

Every transform is a pure ``DataFrame → DataFrame`` function built from
built-in Spark expressions; the caller owns the ``SparkSession``.
"""

from strata.config import DATASETS, GOLD, SILVER, LakePaths

__all__ = ["DATASETS", "GOLD", "SILVER", "LakePaths"]

"""switchflow: customer switching (churn and market flow) analytics on Spark.

Everything here is a DataFrame -> DataFrame function or a Column expression, so
plans stay visible to Catalyst and a caller can compose them freely.
"""

__version__ = "0.1.0"

"""shoprank: purchase prediction and link analysis as Spark DataFrame operators.

Every operator is a function ``f(df, ...) -> DataFrame`` built from the
DataFrame API, so Catalyst plans it and the work stays on the executors.
"""

__version__ = "0.1.0"

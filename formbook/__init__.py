"""formbook: Spark-native operators for event-level sports analytics.

Every operator is a plain ``DataFrame -> DataFrame`` function; column names are
parameters and nothing is collected to the driver unless its size is bounded by
a parameter.
"""

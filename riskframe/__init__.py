"""riskframe: column-role driven tabular risk analytics on Spark.

Every operator is a DataFrame -> DataFrame job (or a fit/transform pair
whose fit is one aggregate).  Nothing row-sized is collected to the driver.
"""

__version__ = "0.1.0"

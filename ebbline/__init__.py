"""Point-in-time churn features, data quality, drift and scoring on Spark.

Every operator takes DataFrames and returns a lazy DataFrame.  Nothing here reads
the clock, owns a session, or pulls data-sized frames to the driver.
"""

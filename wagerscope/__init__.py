"""wagerscope: player-activity analytics as lazy Spark DataFrame functions.

Every operator takes DataFrames and returns a DataFrame.  Nothing is collected
to the driver; the only eager calls are writes and ``pyspark.ml`` fits.
"""

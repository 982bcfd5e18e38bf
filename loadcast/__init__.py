"""loadcast: server load forecasting on Spark.

Session logs are rolled up to five-minute sums and hourly peaks per server, turned into
calendar, rolling-mean and lag features, encoded, and fed to a random forest that
predicts the load class of each server-hour; the same features are built for any set of
servers to score the next 48 hours.
"""

__version__ = "0.1.0"

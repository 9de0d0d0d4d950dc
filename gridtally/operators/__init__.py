"""DataFrame -> DataFrame steps.

No step forces a broadcast: Catalyst and AQE broadcast a dimension when its size is
under ``spark.sql.autoBroadcastJoinThreshold`` and shuffle it when it is not.
"""

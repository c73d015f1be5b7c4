"""Environmental time-series analytics on Spark DataFrames.

Weather and air-quality readings are landed, refined, scored for anomalies and
served as filtered pages.  Every function takes and returns DataFrames; nothing
here opens a session at import time.
"""

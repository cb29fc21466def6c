"""Panel analytics on Spark: one measure per entity and period, plus small dimensions.

Every operator takes and returns a DataFrame. Jobs run in sinks, gates, pipelines and in the three operators that need
a small or sorted table twice and write it to the shared folder: sliced sequences, extremes of groups, latest per key.
"""

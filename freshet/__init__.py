"""freshet: flood-risk analytics as Spark jobs.

Every operator takes DataFrames and returns DataFrames.  Nothing here moves data rows to the driver: the only
actions are counts used as guards, convergence tests of iterative jobs, and streaming triggers.
"""

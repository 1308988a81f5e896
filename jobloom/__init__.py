"""Job-posting lakehouse operators for Spark.

Every public function takes and returns DataFrames or Columns, so a caller
composes one lazy plan and Catalyst sees all of it.  Functions that run a job
"""

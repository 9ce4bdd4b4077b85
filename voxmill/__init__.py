"""voxmill: feedback analytics as Spark jobs.

Every public function takes and returns DataFrames or Columns; nothing here
collects data to the driver in order to compute a result.
"""

"""Document search and analytics over Spark tables.

Every operator takes and returns DataFrames (or Columns) and stays lazy; Catalyst
plans it.  See README.md for the map from operator ids to functions.
"""

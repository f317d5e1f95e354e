"""Operators for training-data pipelines: one module per operator.

Every operator takes and returns DataFrames. ``queries`` holds the registered
``opN_*`` queries, ``oracle`` the SQL for those that SQL can express.
"""

"""Layered daily analytics on Spark: landing, typing, rollups, forecasts, text, checks and search.

Every function takes and returns DataFrames (or Columns) and stays lazy; nothing
here pulls table rows to the driver.
"""

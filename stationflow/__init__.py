"""Hourly station-demand analytics on Spark DataFrames.

Trip or event logs become hourly counts per station, lag features, chronological
train/test frames, model scores, recursive forecasts and report tables.  Every operator
takes and returns DataFrames, works on all stations at once and leaves the physical
plan to Catalyst.
"""

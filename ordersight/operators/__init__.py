"""The analyses: functions from tables to lazy DataFrames."""

"""Attendance-event processing on Spark: decode, admit, enrich, keep, report.

Every operator takes DataFrames and returns a DataFrame; none keeps a global session.
"""

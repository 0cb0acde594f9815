"""Reports: functions from input tables to a table."""

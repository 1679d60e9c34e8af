"""Jobs on the retail tables: functions from DataFrames to DataFrames."""

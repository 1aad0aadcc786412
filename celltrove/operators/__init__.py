"""Table operators: functions from DataFrames to DataFrames, without actions unless said."""

"""Data operators over transaction tables: functions from DataFrame to DataFrame."""

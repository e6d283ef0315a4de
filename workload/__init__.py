"""The driver's tables as inputs of the daily measures, and independent SQL for every query."""

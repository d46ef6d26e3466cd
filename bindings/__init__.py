"""The library's operators bound to the driver's tables, each with its SQL equivalent where SQL can say it."""

"""granary: named, tested Spark operators for tables.

Every operator takes and returns DataFrames, stays lazy wherever Spark allows it and never brings rows to the driver.
"""

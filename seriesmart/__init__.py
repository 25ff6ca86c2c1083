"""PySpark toolkit for building and guarding time-series warehouses.

Every operator is a DataFrame -> DataFrame function, generic over key, date and
value columns. Nothing reads the clock: rules take an ``as_of`` argument.
"""

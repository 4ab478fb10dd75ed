"""Wardline: security-event analytics as PySpark DataFrame operators.

Every operator takes DataFrames plus column roles (``target``, ``ts``, ``src`` ...) and returns a
DataFrame or a Column, so one implementation serves any log schema.
"""

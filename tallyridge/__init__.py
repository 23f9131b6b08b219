"""PySpark operators for event demand series and tabular classification studies."""

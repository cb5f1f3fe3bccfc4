"""Case-surveillance analytics as lazy PySpark DataFrame operators."""

"""tripmarts: trip analytics as PySpark DataFrame jobs, batch and streaming."""

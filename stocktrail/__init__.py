"""Feature-mart and lineage analytics as plain PySpark DataFrame functions."""

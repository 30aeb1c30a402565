"""Table harmonisation, linking and training-data operators on the PySpark DataFrame API."""

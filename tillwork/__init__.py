"""tillwork: retail and restaurant customer analytics as plain PySpark DataFrame functions."""

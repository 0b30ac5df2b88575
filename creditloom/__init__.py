"""Credit feature and label mart as PySpark DataFrame operators."""

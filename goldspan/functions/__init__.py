"""Column functions the hub needs beyond ``pyspark.sql.functions``."""

"""goldspan: master-data hub work (lake scans, record filters and
aggregations, validation, merge, intake, subscriptions) as Spark jobs."""

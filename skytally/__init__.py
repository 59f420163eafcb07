"""Air-traffic analytics on Spark: landed snapshots in, cleaned tables and indicators out."""

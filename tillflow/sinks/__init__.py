"""Writers: partitioned tables, keyed upsert, Gold publishing, JDBC."""

"""Sales-funnel analytics on Spark: raw CRM snapshots in, funnel reports out."""

"""End-to-end plans (mart, ETL, training, dashboard) and the query catalog."""

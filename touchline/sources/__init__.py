"""Reading and writing: CSV scans, the warehouse table, published outputs."""

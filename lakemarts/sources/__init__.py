"""Sources: CSV ingestion into bronze, catalog tables, and the mapping of the
benchmark tables onto the seven raw retail datasets."""

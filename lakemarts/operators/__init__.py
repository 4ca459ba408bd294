"""DataFrame operators of the pipeline: cleansing, deduplication, joins,
the star schema, marts, dashboard tiles, data-quality checks and profiles."""

"""DataFrame -> DataFrame stages: silver, gold, views, quality checks, profile, numbering, joins."""

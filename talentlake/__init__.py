"""talentlake: a listings lake on Spark (bronze landing, silver cleaning,
skill extraction, gold aggregates, market analyses), built from DataFrame
and SQL plans only."""

__version__ = "0.1.0"

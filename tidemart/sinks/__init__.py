"""Writers of topics, statistics tables and dimension tables."""

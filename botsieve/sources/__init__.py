"""Readers: test tables, raw event lines and Kafka records derived from them, views, JDBC."""

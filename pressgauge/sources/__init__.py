"""Readers and writers: logs, dictionaries, JDBC tables, period-partitioned metric tables."""

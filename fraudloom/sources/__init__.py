"""Readers and writers: streams, JDBC tables, the hourly archive, the table adapter."""

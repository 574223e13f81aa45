"""Readers and writers: tables, JSON records, Kafka topics, metrics and run log."""

"""Readers and writers: CSV folders, JSON-lines lake, Kafka, gold tables, logs."""

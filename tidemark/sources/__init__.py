"""Inputs: the given tables, the record topic derived from them, Kafka and
file-stream sources (decoded to topic, partition, offset, key, value, ts)."""

"""Sinks: delimited/JSON/Kafka records, write-ahead ledger, keyed upsert, FS commit records."""

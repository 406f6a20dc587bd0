"""Sources: parquet tables and bindings, record decoders, file/Kafka/JDBC readers."""

"""Sources: events-derived readings, rules CSV, Kafka."""

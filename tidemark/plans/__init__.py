"""End-to-end jobs composed from the operators: traffic counters, landing
ingest, positions-only, checkpoint seeding with repair, live Kafka wiring."""

"""Sources: message topics (Kafka envelope) and object-store files."""

"""Sinks: tables (append / keyed upsert), line protocol, per-record transports, topics."""

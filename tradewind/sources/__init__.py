"""Readers and writers: message topics, day-partitioned tables, offset ledger, relational and derived inputs."""

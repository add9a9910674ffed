"""Readers: Kafka, CSV, JSON vocabulary artifacts and file replays."""

"""Query catalogue (Spark plans) and their independent SQL oracles."""

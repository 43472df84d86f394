"""DataFrame operators: clips, segments, statistics, export, topics, fingerprints."""

"""Tables kept by files: keyed change feeds, partition merges, compaction."""

"""Operations of a large text-data pipeline: cleaning, deduplication, search, archives, packing."""

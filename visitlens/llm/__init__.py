"""Operations on text corpora: extraction, cleaning, deduplication, mixing, encoding."""

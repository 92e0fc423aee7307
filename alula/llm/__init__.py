"""Operations on training text: deduplication, mixing, encoding, extraction and classification."""

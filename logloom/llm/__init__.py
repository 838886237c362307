"""Operations on corpora of training text."""

"""Operations on training text, vectors and pages; nothing else in the package imports them."""

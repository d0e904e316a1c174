"""Rows that every operator has to bear: NULLs, empty and very long texts, ties and repeated rows."""

LONG = " ".join(f"word{i % 977} stands here" for i in range(40_000))

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away."),
    (1, "The quick brown fox jumps over the lazy dog and runs away."),
    (2, None),
    (3, ""),
    (None, "A text without a key, which nobody can name."),
    (4, "   \n\t \n"),
    (5, "one"),
    (6, LONG),
    (7, "ÀÉ ß 你好 Σ\u0301 x\u00a0y 'tis 12½ <|endoftext|> end\x00of"),
    (7, "another text under the same key"),
]

"""Texts at the edges."""

#: nulls, empty and blank texts, very short and very long ones, other scripts, odd white space
ODD = [
    None, "", " ", "\n\n", "one", "ONE", "two  words ", " a\tb\x0bc\x0cd\re\nf", "é 中文 😀 ﬁ ▁x ▁", "x" * 50_000,
    "same line\nsame line\nsame line\n", "\x00 nul", "tail space ", "a.\nb, c!  d", "<|endoftext|> <s> </s>",
]

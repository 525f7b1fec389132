import pytest


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty texts, ties, repeated rows, long words and odd characters."""
    return [
        None, "", " ", "   ", "a", "\n\n\n", "a  b\tc\n<s> </s> ﬁ ", "  two  spaces  ", "café \U0001f600 ▁x ▁▁",
        "don't we'll I'D 12345 ١٢ ½Ⅷ á", "<|endoftext|> a<|endoftext|><|endoftext|>b <|endoftext",
        "x" * 20_000, "你好世界" * 50, "line one\nline two\nline three\nline four",
        "\x00\x01\x1c\x1d\x85 ​ 　 end", "same text", "same text", "\r\n\r\n  \t mixed \v\f white", "!!! ### $$$",
        "Word " * 3000, "﻿�\U00010ffff",
    ]

"""Texts that end in white space, under a rank file with a token of two spaces."""

import base64

import public_tokenizers

from ledgerlark.llm import bpe


def test_white_space_at_the_end_is_not_cut(tmp_path):
    tokens = [bytes([b]) for b in range(256)] + [b"  ", b"\n "]
    path = tmp_path / "ranks"
    path.write_text("".join(f"{base64.b64encode(t).decode()} {n}\n" for n, t in enumerate(tokens)))
    coder = bpe.ByteBpe(str(path), public_tokenizers.PATTERN)
    for text in ("a  ", "a\n ", "  ", "a   ", "a b \t ", "a ", " ", ""):
        assert coder.encode(text) == coder.encode_plain(text), repr(text)

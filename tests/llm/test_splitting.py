"""What took more than it had to in round 3."""

import re

import public_tokenizers

from microblog.llm import pieces
from microblog.llm.tokens import encoder, read_tokenizer


def test_texts_are_searched_for_double_spaces_only_where_one_may_be(monkeypatch):
    data = read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    from tokenizers import Tokenizer

    lib, searched = Tokenizer.from_str(data), []

    class Counted:
        def search(self, text):
            searched.append(text)
            return re.search(r"\s ", text)

    monkeypatch.setattr(pieces, "_SPACE_AFTER_SPACE", Counted())
    encode = encoder(data, public_tokenizers.PATTERN)
    plain = ["Some plain words, in a row.", "one", "line\nbreak inside", "café au lait"]
    odd = ["two  spaces", " ahead", "behind ", "tab\t then", "a  b", "", "  ", "\n x", "end \n", "x \n y"]
    want = lambda ts: [b"".join(i.to_bytes(4, "little") for i in lib.encode(t, add_special_tokens=False).ids) for t in ts]
    assert encode(plain) == want(plain) and searched == []
    assert encode(plain + odd + plain) == want(plain + odd + plain)
    assert searched and not set(searched) & set(plain)

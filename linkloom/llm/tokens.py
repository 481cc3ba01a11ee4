"""Ids of whole texts by public tokenizer files, and the bytes of each id."""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: How a byte-level vocabulary of this kind splits a text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose class every library agrees on; texts with others go to the tokenizer's own library.
_OTHER = re.compile("[^\t\n\r\x20-\x7e\xa1-ſ]")


class ByteTokens:
    """Ids by a byte-level tokenizer file (``data``: its content).

    Texts of common characters are merged by rank with the file's vocabulary, several
    times faster than by the tokenizer itself and with the same ids (tested).  A text with
    other characters or a special token's string goes to the tokenizer.
    With ``plain_specials`` such strings are text as any other.
    """

    def __init__(self, data: str, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(data)
        self.tokenizer.encode_special_tokens = plain_specials
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = [] if plain_specials else list(special)
        # the printable stand-ins of a byte-level vocabulary: other bytes follow from U+0100 on
        plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        back = {chr(b): b for b in plain}
        back |= {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(map(back.__getitem__, entry)): i
                 for entry, i in json.loads(data)["model"]["vocab"].items() if entry not in special}
        self.merger = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for value, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
            self.bytes[i] = value

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as uint32."""
        out, rest = [], []
        for i, text in enumerate(texts):
            if _OTHER.search(text) or any(s in text for s in self.special):
                rest.append(i)
                out.append(None)
            else:
                out.append(self.merger.encode_to_numpy(text, disallowed_special=()))
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = np.array(e.ids, np.uint32)
        return out


class PieceTokens:
    """Ids by a sentence-piece model file (``data``: its content), which puts a blank before each
    text by itself."""

    def __init__(self, data: bytes):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in ((i, self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.uint32) for x in self.model.encode(texts, num_threads=1)]

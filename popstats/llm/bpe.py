"""Ids of a byte-level BPE file exactly as ``tokenizers`` gives them, at several times its speed.

The file's vocabulary is handed to ``tiktoken``, whose merge ranks are the ids
themselves.  Both libraries split a text by the same pattern, but each with
its own Unicode tables: every character is therefore compared once per worker
(does it join a letter, a digit, a sign?), and a text holding a character on
which they differ is encoded by ``tokenizers``.  A file that is not plain
byte-level BPE with ids in merge order is encoded by ``tokenizers`` alone.
"""

from __future__ import annotations

import json
import os

import numpy as np

# Fixed value: the byte-level pre-token pattern that such vocabularies are made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SIDES = ("a", "1", ".")  # a letter, a digit, neither: what a character joins tells its class


def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for U+0100 onwards, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """One worker's encoder.  ``added``: strings of added tokens inside a text become their ids, else they are plain text."""

    def __init__(self, path: str, added: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = not added
        spec = json.loads(self.exact.to_str())
        pre, model, extra = spec.get("pre_tokenizer") or {}, spec["model"], spec.get("added_tokens") or []
        names = {a["content"]: a["id"] for a in extra}
        alphabet = byte_of_char()
        #: the bytes of every id, as far as ids are given
        self.bytes = [b""] * (1 + max([*model["vocab"].values(), *names.values()], default=0))
        for token, i in model["vocab"].items():
            if token not in names:
                self.bytes[i] = bytes(alphabet[c] for c in token)
        for name, i in names.items():
            self.bytes[i] = name.encode()
        ranks = {self.bytes[i]: i for t, i in model["vocab"].items() if t not in names}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges") or []]
        made = [model["vocab"][a + b] for a, b in merges]
        plain = (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                 and not spec.get("normalizer") and made == sorted(made) and len(ranks) == 256 + len(made)
                 and not any(a[k] for a in extra for k in ("single_word", "lstrip", "rstrip", "normalized")) and len(extra) <= 1)
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=names) if plain else None
        self.allowed = set(names) if added else set()
        self.known: set[str] = set()
        self.odd: set[str] = set()
        if plain:
            self._compare({chr(i) for i in range(128)})

    def _compare(self, chars: set[str]) -> None:
        import tiktoken

        words = [s + c + s for c in chars for s in _SIDES]
        ranks = {bytes([i]): i for i in range(256)}
        for w in words:
            ranks.setdefault(w.encode(), len(ranks))
        probe = tiktoken.Encoding("probe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        split = self.exact.pre_tokenizer.pre_tokenize_str
        for c in chars:  # a word that is one pre-token is one id, any other is several
            if any((len(probe.encode_ordinary(s + c + s)) == 1) != (len(split(s + c + s)) == 1) for s in _SIDES):
                self.odd.add(c)
        self.known |= chars

    def ids(self, text: str | None) -> np.ndarray:
        """The ids of a whole text (uint32); none for NULL."""
        if not text:
            return np.zeros(0, np.uint32)
        if self.fast is not None:
            if not text.isascii() and (new := set(text) - self.known):
                self._compare(new)
            if not self.odd or self.odd.isdisjoint(text):
                return self.fast.encode_to_numpy(text, allowed_special=self.allowed, disallowed_special=())
        return np.asarray(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)

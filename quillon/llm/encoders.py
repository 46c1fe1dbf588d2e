"""Token ids of whole texts, exactly as the library of a public tokenizer file gives them.

A ``tokenizers`` file that holds a plain byte-level BPE also runs in a faster engine with the same
vocabulary. Only texts made of characters whose classes never differed between Unicode versions, and
without the string of a special token, go there; all others go to the library itself. Files with
another kind of model go to the library always.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from importlib.metadata import version

import numpy as np

# The split pattern of byte-level BPE files, and the characters both engines class alike.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e¡-ſ–-”]")

_LOADED: dict[str, Encoder] = {}


class Encoder:
    """``encode`` gives a text's ids as unsigned 32-bit integers, without begin, end or added special tokens."""

    def __init__(self, path: str):
        self.piece = self.exact = self.fast = self.special = None
        if path.endswith(".model"):
            import sentencepiece

            self.piece = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.no_truncation()
        self.exact.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        strings = [re.escape(t["content"]) for t in spec.get("added_tokens") or []]
        self.special = re.compile("|".join(strings)) if strings else None
        self.fast = _byte_level_engine(spec)

    def encode(self, text: str) -> np.ndarray:
        if self.piece is not None:
            return np.array(self.piece.encode(text, add_bos=False, add_eos=False), "<u4")
        if self.fast is not None and not UNUSUAL.search(text) and not (self.special and self.special.search(text)):
            return np.array(self.fast.encode_ordinary(text), "<u4")
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4")

    def count(self, text: str) -> int:
        return len(self.encode(text))


def _byte_level_engine(spec: dict):
    """The same byte-level BPE in tiktoken, or None if the file holds more or less than one."""
    import tiktoken

    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
        and not pre.get("add_prefix_space") and spec.get("normalizer") is None and not model.get("dropout")
        and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
    )
    if not plain:
        return None
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to_byte = {chr(b): b for b in printable}
    to_byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    vocabulary = model["vocab"]
    made = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    if made != sorted(made):
        return None  # merge order and ids differ: ids can't serve as ranks
    added = {t["content"] for t in spec.get("added_tokens") or []}
    ranks = {bytes(to_byte[c] for c in token): i for token, i in vocabulary.items() if token not in added}
    return tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def encoder(path: str) -> Encoder:
    """The encoder of a file, loaded once in each process."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def encoder_version(path: str) -> str:
    """Hex digest of what decides the ids: the file's bytes and the library's version."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + f"\n{library} {version(library)}".encode()).hexdigest()

"""Tokenizer files as id -> bytes tables, with the encoders that go with them."""

from __future__ import annotations

import json

import numpy as np

SPACE_MARK = "▁"  # what a piece vocabulary writes for a space


def byte_symbols() -> dict[str, int]:
    """The characters that byte-level vocabularies write for the 256 bytes.

    Bytes with a printable Latin-1 character stand for themselves, the others follow from U+0100 on in
    ascending order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + n): b for n, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE vocabulary in the ``tokenizers`` JSON format.

    Texts are encoded with the ranks of the same file by ``tiktoken``: its ids are those of the
    ``tokenizers`` library (compared on every code point in tests) at a third of the time. The ids of a
    merge must follow the order of the merges, else the file is refused.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbols = byte_symbols()
        spelled = {bytes(symbols[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        merged = [spelled[b"".join(bytes(symbols[c] for c in side) for side in self._pair(m))] for m in spec["model"]["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:])):
            raise ValueError(f"ids of {path} do not follow the order of its merges")
        added = {token["content"]: token["id"] for token in spec.get("added_tokens", [])}
        self.library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=spelled, special_tokens=added)
        self.size = max([*spelled.values(), *added.values()]) + 1
        self.bytes_of = [b""] * self.size
        for token, i in [*spelled.items(), *((token.encode(), i) for token, i in added.items())]:
            self.bytes_of[i] = token
        self.lengths = np.array([len(token) for token in self.bytes_of], dtype=np.int64)

    @staticmethod
    def _pair(merge) -> list[str]:
        return merge.split(" ") if isinstance(merge, str) else merge

    def encode(self, text: str, special: bool) -> np.ndarray:
        """Ids of ``text``; ``special``: strings of added tokens become their ids, else they are plain text."""
        return self.library.encode_to_numpy(text, allowed_special="all" if special else set(), disallowed_special=())


class Pieces:
    """A sentencepiece model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.library.get_piece_size()
        self.bytes_of = [self._bytes(i) for i in range(self.size)]
        self.lengths = np.array([len(token) for token in self.bytes_of], dtype=np.int64)

    def _bytes(self, i: int) -> bytes:
        piece = self.library.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.library.is_byte(i) else piece.replace(SPACE_MARK, " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


# Characters that Python, the regex library and the tokenizers library take alike (their Unicode versions
# differ on newer ones): compared one by one in tests. Texts with any other are left to the library.
ALIKE = "\\0-\\u0557\\u2000-\\u208e\\u20a0-\\ua7ca\\uac00-\\ud7ff\\ue000-\\uffff"


class WordEnds:
    """A BPE vocabulary with word ends (``</w>``) in the ``tokenizers`` JSON format.

    The library lower-cases, drops white space, splits words off by a pattern and merges each with a mark on
    its last symbol. Here the pattern runs in a regular expression and the words, each followed by a space
    as its end mark, go through ``tiktoken``: space is in no word, and a last byte joins its mark before
    anything else merges, which gives the library's ids at a quarter of the time (compared in tests).
    Files with another normalizer or pattern are refused.
    """

    NORMALIZERS = ("NFC", "Replace", "Lowercase")
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        import re

        import regex
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kinds = tuple(part["type"] for part in spec["normalizer"]["normalizers"])
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if kinds != self.NORMALIZERS or split["pattern"] != {"Regex": self.PATTERN} or spec["model"]["end_of_word_suffix"] != "</w>":
            raise ValueError(f"{path} normalizes or splits in another way")
        self.library = Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size()
        self.special = [token["content"] for token in spec["added_tokens"]]
        symbols = byte_symbols()

        def spelled(token: str) -> bytes:
            core = token.removesuffix("</w>")
            return bytes(symbols[c] for c in core) + (b" " if core != token else b"")

        ids = {spelled(token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        ranks = {bytes([b]) + b" ": n for n, b in enumerate(b for b in range(256) if b != 0x20)}
        for merge in spec["model"]["merges"]:
            ranks.setdefault(b"".join(map(spelled, ByteLevel._pair(merge))), len(ranks))
        for b in range(256):
            ranks.setdefault(bytes([b]), len(ranks))
        self.id_of = np.zeros(len(ranks), dtype=np.uint32)
        for token, rank in ranks.items():
            self.id_of[rank] = ids.get(token, 0)
        self.merges = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.words = regex.compile(self.PATTERN).findall
        self.ascii_words = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-z]+|[0-9]|[^\sa-z0-9]+").findall
        self.odd = re.compile(f"[^{ALIKE}]").search

    def encode(self, text: str) -> np.ndarray:
        """Ids of ``text``; strings of added tokens become their ids, as by the library's default."""
        import unicodedata

        plain = text.isascii()
        if any(token in text for token in self.special) or not plain and self.odd(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        if plain:
            words = self.ascii_words(text.lower())
        else:
            text = unicodedata.normalize("NFC", text)
            # The library lower-cases each character by itself; only a final sigma depends on its neighbours.
            words = self.words("".join(map(str.lower, text)) if "Σ" in text else text.lower())
        marked = " ".join(words) + " " if words else ""
        return self.id_of[self.merges.encode_to_numpy(marked, disallowed_special=())]

"""Public tokenizer files, read where they are needed; vocabularies are never copied."""

from __future__ import annotations

import base64
import json
import re
import unicodedata

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

from .shared import Memo

#: How byte-level vocabularies spell the 256 bytes as printable characters.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_letters() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte."""
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


#: Text in which the libraries' ideas of letters, digits and white space cannot differ.
PLAIN = re.compile(r"[!-~¡-¬®-ſ]*")


class WordBpe:
    """ids of a lower-casing word-end BPE file, chunk of non-space bytes by chunk.

    White space never reaches this model's tokens, so a text is the sequence of its space-parted chunks. A chunk
    of plain characters goes through the same merges on a faster engine: 0xFF, which no UTF-8 holds, marks a word's
    end and its merges come first. Every other chunk is encoded by the tokenizers library itself.
    """

    def __init__(self, path: str, dtype: str = "<u2"):
        self.library, self.dtype = Tokenizer.from_file(path), dtype
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, letters = model["vocab"], byte_letters()
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split)
        end = model["end_of_word_suffix"]
        ranks, ids = {}, {}
        for letter, byte in letters.items():
            for key, rank, name in ((bytes([byte, 255]), byte, letter + end), (bytes([byte]), 256 + byte, letter)):
                ranks[key], ids[rank] = rank, vocab[name]
        for i, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            last = b.endswith(end)
            spelled = a + (b[: -len(end)] if last else b)
            key = bytes(letters[c] for c in spelled) + b"\xff" * last
            ranks[key], ids[512 + i] = 512 + i, vocab[a + b]
        self.core = tiktoken.Encoding("words", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.spelled = {rank: np.array(i, dtype).tobytes() for rank, i in ids.items()}
        #: Bare letters, and letters before one of these marks, part in one way only, whatever the special strings.
        self.bare = not self.special.search("abc") and self.pieces.findall("abc") == ["abc"]
        self.marks = {m.encode(): m for m in ".,;:?" if self.pieces.findall("abc" + m) == ["abc", m] and not self.special.search("abc" + m)}
        self.words = Memo(self._word)
        self.chunks = Memo(self._chunk)

    def _word(self, word: str) -> bytes:
        return b"".join(map(self.spelled.__getitem__, self.core.encode_single_piece(word.encode() + b"\xff")))

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if self.bare and chunk.isalpha():  # of bytes: ASCII letters alone
            return self.words[text.lower()]
        if (mark := self.marks.get(chunk[-1:])) and chunk[:-1].isalpha():
            return self.words[text[:-1].lower()] + self.words[mark]
        if PLAIN.fullmatch(text) and not self.special.search(text):
            lower = "".join(map(str.lower, text))
            if text.isascii() or (unicodedata.is_normalized("NFC", text) and PLAIN.fullmatch(lower)):
                return b"".join(map(self.words.__getitem__, self.pieces.findall(lower)))
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, text: bytes) -> bytes:
        """ids of UTF-8 text, as little-endian integers of self.dtype."""
        return b"".join(map(self.chunks.__getitem__, text.split()))

    def trim(self) -> None:
        self.words.trim()
        self.chunks.trim()


class SpacedChunks:
    """Cuts a text into chunks that a byte-level BPE of the usual pattern encodes one by one.

    A single space or line feed between two plain characters always ends one pre-token and starts another, so the text
    falls apart there: the space belongs to what follows it; the line feed stands alone. None: the text has longer
    runs of white space, or other characters, and must be encoded whole. In a chunk, "\\x01" stands for a line feed
    before it, "\\x02" for the text's start; any other chunk follows a space.
    """

    ODD = re.compile(r"[^\n -~¡-¬®-ſ]|[ \n][ \n]|^[ \n]|[ \n]\Z")

    @classmethod
    def cut(cls, text: str) -> list[str] | None:
        if not text:
            return []
        if cls.ODD.search(text):
            return None
        return ("\x02" + text.replace("\n", " \x01")).split(" ")

    @staticmethod
    def whole(chunk: str) -> str:
        """The text that a chunk stands for."""
        return chunk[1:] if chunk[0] == "\x02" else "\n" + chunk[1:] if chunk[0] == "\x01" else " " + chunk

"""Token ids of whole texts with a public tokenizer file.

For the lower-casing word tokenizer, texts of common characters go through a table of pre-tokens:
its normaliser leaves those characters composed, and its pre-tokens never depend on each other, so the
ids of a text are the ids of its pre-tokens one after another. A pre-token is encoded once a worker.
All other texts, and all other tokenizers, take the tokenizer's own path. Both give equal ids.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import islice

import numpy as np

#: Entries that a worker keeps: about 100 MB.
TABLE = 500_000

# Common characters: ASCII, Latin, general punctuation and the euro sign; no controls, no marks.
_UNUSUAL = re.compile("[^\t\n\r -~¡-ɏ‐-‧‰-⁞€]|<\\|")
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = "\t\n\r "
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
# Fixed value: the pre-token pattern of the tokenizer that the table serves.
_SERVED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_CHUNK = 200_000


def _spelling() -> dict[int, str]:
    """Byte-level spelling: printable bytes stand for themselves, the others for letters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


_SPELLING = _spelling()


class Encoder:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        vocabulary = self.tokenizer.get_vocab()
        size = max(vocabulary.values()) + 1
        self.word_end, self.sentence_end = np.zeros(size, bool), np.zeros(size, bool)
        for token, i in vocabulary.items():
            self.word_end[i] = token.endswith("</w>")
            self.sentence_end[i] = bool(re.search(r"[.!?][\"')\]]*(</w>)?$|Ċ$", token))
        parts = (said.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        steps = [x["type"] for x in (said.get("normalizer") or {}).get("normalizers", [])]
        self.by_table = (
            parts[0].get("pattern", {}).get("Regex") == _SERVED
            and steps == ["NFC", "Replace", "Lowercase"]
            and said["model"].get("end_of_word_suffix") == "</w>"
        )
        self.table: dict[str, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        """Unsigned 32-bit ids, without special ones."""
        if self.by_table and not _UNUSUAL.search(text):
            lowered = text.lower()
            if not _UNUSUAL.search(lowered):
                pieces = _PIECES.findall(lowered)
                try:
                    return np.frombuffer(b"".join(map(self.table.__getitem__, pieces)), "<u4")
                except KeyError:
                    self._learn([p for p in dict.fromkeys(pieces) if p not in self.table])
                    # What a full table gave up is encoded again; a text with more pieces than it holds is not.
                    if all(map(self.table.__contains__, pieces)):
                        return np.frombuffer(b"".join(map(self.table.__getitem__, pieces)), "<u4")
                    self._learn([p for p in dict.fromkeys(pieces) if p not in self.table])
                    if all(map(self.table.__contains__, pieces)):
                        return np.frombuffer(b"".join(map(self.table.__getitem__, pieces)), "<u4")
        return self._direct(text)

    def _learn(self, pieces: list[str]) -> None:
        """Encodes new pieces; a full table goes back to its earliest half, which are the commonest."""
        if len(self.table) + len(pieces) > TABLE:
            self.table = dict(islice(self.table.items(), TABLE // 2))
        tokenize, table = self.tokenizer.model.tokenize, self.table
        for p in pieces:
            spelt = p if p.isascii() else p.encode().decode("latin-1").translate(_SPELLING)
            table[p] = b"".join([t.id.to_bytes(4, "little") for t in tokenize(spelt)])

    def _direct(self, text: str) -> np.ndarray:
        """By the tokenizer itself; very long texts in parts that end before white space, if it drops that."""
        parts, at = [], 0
        while self.by_table and len(text) - at > _CHUNK:
            cut = text.find(" ", at + _CHUNK)
            if cut < 0:
                break
            parts.append(text[at:cut])
            at = cut
        parts.append(text[at:])
        ids = [np.asarray(self.tokenizer.encode(p, add_special_tokens=False).ids, "<u4") for p in parts]
        return ids[0] if len(ids) == 1 else np.concatenate(ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One a worker."""
    return Encoder(path)

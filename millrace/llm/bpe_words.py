"""Byte-level BPE of whole texts."""

from __future__ import annotations

import re
from array import array

from millrace.llm import vocabulary
from millrace.llm.common import of_worker


class WordEncoder:
    """Encodes whole texts. They are first split at ``added`` tokens, the longest where several begin, and what lies between is encoded apart."""

    def __init__(self, path: str, added: dict[str, int] | None = None) -> None:
        self.bpe = vocabulary.byte_bpe(path)
        added = added or {}
        self.dtype = "<u2" if max([self.bpe.n_vocab, *(i + 1 for i in added.values())]) <= 1 << 16 else "<u4"
        self.code = "H" if self.dtype == "<u2" else "I"
        self.added = {t: array(self.code, [i]).tobytes() for t, i in added.items()}
        self.at_added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    def encode(self, text: str) -> bytes:
        """The ids as little-endian numbers of type ``dtype``."""
        if not any(t in text for t in self.added):
            return self._plain(text)
        return b"".join(self.added[t] if k % 2 else self._plain(t) for k, t in enumerate(self.at_added.split(text)))

    def _plain(self, text: str) -> bytes:
        return array(self.code, self.bpe.encode_ordinary(text)).tobytes()


def encoder(path: str, added_path: str | None = None) -> WordEncoder:
    """The encoder of this Python worker, with the added tokens of the json at ``added_path``."""
    return of_worker(f"encoder {path} {added_path}", lambda: WordEncoder(path, vocabulary.added_tokens(added_path) if added_path else None))

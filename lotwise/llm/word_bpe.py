"""Word-level BPE ids by a ``tokenizers`` file, as ``Tokenizer.encode`` gives them.

White space always parts words in such a file, so a text is cut at ASCII blanks and each
distinct chunk is encoded once a task and kept in a memo of bounded size. New chunks of
printable ASCII and Latin letters are encoded many at a time by tiktoken, over the file's
own vocabulary with a closing byte for ``</w>``; every other chunk, and any that spells an
added token, goes through ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

MEMO_BYTES = 48 << 20
ENTRY_BYTES = 160  # of a memo entry beside its chunk and ids
WORD_END = "</w>"
# The file's own pre-token rule, for lower-cased printable ASCII and Latin letters only.
PRE_TOKENS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ a-z0-9ß-öø-ÿ]+")
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
PLAIN_CHUNKS = re.compile(r"[ -~À-ÖØ-öø-ÿ]*")
# A text all of whose letters are plain may be lowered as a whole. A comma or full stop before a
# blank is a pre-token of its own, so that a blank may be put before it, but after other signs.
PLAIN_TEXT = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
SIGN_RUN = re.compile(r"[!-/:-@\[-`{-~][.,][ \n]")
ENDINGS = (", ", ". ", ",\n", ".\n")
# ``str.split`` would also cut at these, which are no white space to the tokenizer's rules.
ODD_BLANKS = re.compile(r"[\x1c-\x1f]")
BLANKS = re.compile(r"[ \t-\r]+")


def _byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes: printable ones for themselves, the rest from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in shown}
    for i, byte in enumerate(sorted(set(range(256)) - set(shown))):
        letters[chr(256 + i)] = byte
    return letters


@lru_cache(maxsize=2)
def load(path: str) -> tuple[Tokenizer, tiktoken.Encoding, np.ndarray, tuple[str, ...]]:
    """The tokenizer, the same over bytes, the ids that part chunks, and the added tokens."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    letters, ranks = _byte_of_letter(), {}
    for token, rank in content["model"]["vocab"].items():
        closes = token.endswith(WORD_END) and token != WORD_END
        body = token[: -len(WORD_END)] if closes else token
        ranks[bytes(letters[c] for c in body) + b"\0" * closes] = rank
    encoding = tiktoken.Encoding(
        "closed words", pat_str=r"[^\x00 ]+\x00| ", mergeable_ranks=ranks, special_tokens={}
    )
    added = tuple(t["content"] for t in content["added_tokens"])
    return Tokenizer.from_file(path), encoding, ranks[b" "], added


class WordEncoder:
    """Ids of texts, as packed little-endian unsigned 16-bit integers."""

    def __init__(self, path: str):
        self.tokenizer, self.encoding, self.blank, self.added = load(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("Ids of this vocabulary do not fit 16 bits")
        self.memo: dict[str, bytes] = {}
        self.held = 0

    def encode(self, texts: list[str]) -> list[bytes]:
        chunks = [self._chunks(text) for text in texts]
        known = self.memo
        new = list(set().union(*chunks).difference(known))
        fresh = self._encode_new(new)
        self.held += sum(map(len, new)) + sum(map(len, fresh.values())) + ENTRY_BYTES * len(new)
        known.update(fresh)
        ids = [b"".join(map(known.__getitem__, row)) for row in chunks]
        if self.held > MEMO_BYTES:
            known.clear()
            self.held = 0
        return ids

    def _spells_added(self, text: str) -> bool:
        return any(token in text for token in self.added)

    def _chunks(self, text: str) -> list[str]:
        if PLAIN_TEXT.fullmatch(text) and not self._spells_added(text):
            text = text.lower()
            if not SIGN_RUN.search(text):
                for ending in ENDINGS:
                    text = text.replace(ending, " " + ending)
        return BLANKS.sub(" ", text).split(" ") if ODD_BLANKS.search(text) else text.split()

    def _encode_new(self, chunks: list[str]) -> dict[str, bytes]:
        joined = " ".join(chunks)
        plain, found = chunks, {}
        if not PLAIN_CHUNKS.fullmatch(joined) or self._spells_added(joined):
            plain, others = [], []
            for chunk in chunks:
                simple = PLAIN.fullmatch(chunk) and not self._spells_added(chunk)
                (plain if simple else others).append(chunk)
            encoded = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
            found = {c: np.array(e.ids, "<u2").tobytes() for c, e in zip(others, encoded, strict=True)}
        words = [chunk for chunk in plain if chunk.isalpha()]  # a pre-token each
        mixed = [chunk for chunk in plain if not chunk.isalpha()]
        found.update(self._encode_closed(words, "\0 ".join(words).lower() + "\0"))
        found.update(self._encode_closed(mixed, PRE_TOKENS.sub("\\g<0>\0", " ".join(mixed).lower())))
        return found

    def _encode_closed(self, chunks: list[str], closed: str) -> Iterator[tuple[str, bytes]]:
        """``closed``: the chunks with a closing byte after each pre-token, a blank between chunks."""
        if not chunks:
            return iter(())
        ids = np.array(self.encoding.encode_ordinary(closed), "<u2")
        packed = ids.tobytes()
        blanks = 2 * np.flatnonzero(ids == self.blank)
        starts, ends = [0, *(blanks + 2).tolist()], [*blanks.tolist(), len(packed)]
        parts = (packed[a:b] for a, b in zip(starts, ends, strict=True))
        return zip(chunks, parts, strict=True)

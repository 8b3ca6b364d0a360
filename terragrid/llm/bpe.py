"""Byte-level BPE by pre-token lookup, shared by the token counter and the packer.

A text is cut into pre-tokens; what each becomes is looked up, never computed
twice in a worker.  The pieces are those of the ``tokenizers`` library: its
pre-tokens are cut by the same pattern, and a special string inside a text is
the one added token, as its default has it.
"""

from __future__ import annotations

import functools
import json
from array import array
from collections.abc import Iterator

import numpy as np
import regex

#: The pre-token pattern of byte-level BPE vocabularies (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries that a worker's cache holds before it is emptied, and the longest pre-token kept.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 64
#: Pre-tokens handled at once in a very long text.
RUN = 1 << 16
#: Characters above which a text is scanned piece by piece.
LONG_TEXT = 1 << 20


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def tokenizer(path: str):
    """The library's tokenizer; one a process."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_of_char() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies: visible Latin-1 characters for themselves, the rest from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.cache
def piece_encoder(path: str):
    """A function from a pre-token to its ids.

    Where the vocabulary's merges stand in the order of their ids, merging by
    rank is the same as merging by id, and the quicker rank encoder is used;
    else the library's own.
    """
    model = json.load(open(path, encoding="utf-8"))["model"]
    vocab, back = model["vocab"], byte_of_char()
    made = [vocab["".join(x.split(" ") if isinstance(x, str) else x)] for x in model["merges"]]
    if any(a >= b for a, b in zip(made, made[1:], strict=False)):
        own = tokenizer(path)
        return lambda piece: own.encode(piece, add_special_tokens=False).ids
    import tiktoken

    added = set(splitter(path)[1])
    ranks = {bytes(back[c] for c in token): i for token, i in vocab.items() if token not in added}
    core = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe
    return lambda piece: core.encode_single_piece(piece.encode())


@functools.cache
def splitter(path: str):
    """The pattern that finds the added tokens, with their ids; None without any."""
    added = {x["content"]: x["id"] for x in json.load(open(path, encoding="utf-8"))["added_tokens"]}
    if not added:
        return None, {}
    return regex.compile("(" + "|".join(regex.escape(x) for x in sorted(added, key=len, reverse=True)) + ")"), added


_WORDS = regex.compile(PATTERN)


class Pieces(dict):
    """Worker cache: pre-token to the bytes of its ids (little-endian unsigned 32-bit).

    ``known`` is a broadcast first tier that is only read.  A miss is encoded
    and kept; a full cache starts anew, so its size is bounded.
    """

    def __init__(self, path: str, known: dict | None = None, lengths: bool = False):
        super().__init__(known or {})
        self.path, self.known, self.lengths, self.misses = path, known or {}, lengths, 0
        self.encode = piece_encoder(path)

    def __missing__(self, piece: str):
        ids = self.encode(piece)
        value = len(ids) if self.lengths else array("I", ids).tobytes()
        self.misses += 1
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES + len(self.known):
                self.clear()
                self.update(self.known)
            self[piece] = value
        return value


def pretokens(text: str) -> Iterator[list[str]]:
    """The pre-tokens of a text without added tokens, in lists of bounded length."""
    if len(text) <= LONG_TEXT:
        yield _WORDS.findall(text)
        return
    run = []
    for m in _WORDS.finditer(text):
        run.append(m[0])
        if len(run) == RUN:
            yield run
            run = []
    yield run


def parts(text: str, path: str) -> Iterator[tuple[str, int | None]]:
    """The text between added tokens (id None), and the added tokens with their ids."""
    pattern, added = splitter(path)
    if pattern is None or not any(x in text for x in added):
        yield text, None
        return
    for part in pattern.split(text):
        if part in added:
            yield part, added[part]
        elif part:
            yield part, None


def count_tokens(text: str | None, pieces: Pieces) -> int:
    """Number of tokens of a whole text."""
    if not text:
        return 0
    n = 0
    for part, special in parts(text, pieces.path):
        n += 1 if special is not None else sum(sum(map(pieces.__getitem__, run)) for run in pretokens(part))
    return n


def encode_ids(text: str | None, pieces: Pieces) -> bytes:
    """Ids of a whole text as little-endian unsigned 32-bit values."""
    if not text:
        return b""
    out = []
    for part, special in parts(text, pieces.path):
        if special is not None:
            out.append(array("I", [special]).tobytes())
        else:
            out += [b"".join(map(pieces.__getitem__, run)) for run in pretokens(part)]
    return b"".join(out)

"""Token ids of the public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Letters and white space beyond these blocks (Latin and general punctuation) may be classed by another
#: Unicode version in the second library, so texts that have any go to the first.
OTHER = re.compile(r"[^\x00-ɏ‐-‧‰-⁞]")
#: Texts longer than this are given to the encoder in parts that end before a space after a letter, where
#: the vocabulary's pattern always starts a new word.
PART = 1 << 20
CUT = re.compile(r"(?<=[a-zA-Z]) (?=[a-zA-Z])")


@lru_cache(1)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(1)
def _added(path: str) -> re.Pattern:
    """The tokens that the vocabulary file adds and finds in texts before any pattern."""
    return re.compile("|".join(re.escape(t.content) for t in _library(path).get_added_tokens_decoder().values()) or "(?!)")


@lru_cache(1)
def _ranks(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def parts(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > PART:
        cut = CUT.search(text, start + PART)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(text: str | None) -> np.ndarray:
    """Ids of a text without special tokens; a null text is empty.

    The rank file holds the same vocabulary and gives the same ids about four times as fast, so it
    encodes what is surely split the same way; all other texts are encoded by the vocabulary file, also
    those that hold a token it adds, which is one id there and unknown to the rank file.
    """
    if not text:
        return np.empty(0, np.uint32)
    vocabulary = public_tokenizers.path(VOCABULARY)
    if OTHER.search(text) or _added(vocabulary).search(text):
        encoder = _library(vocabulary)
        found = [encoder.encode(part, add_special_tokens=False).ids for part in parts(text)]
    else:
        encoder = _ranks(public_tokenizers.path(RANKS))
        found = [encoder.encode_ordinary(part) for part in parts(text)]
    return np.concatenate([np.array(ids, np.uint32) for ids in found])

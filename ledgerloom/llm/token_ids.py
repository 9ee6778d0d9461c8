"""Token ids of whole texts, equal to those of the ``tokenizers`` library for a byte-level vocabulary file.

The vocabulary is read as the ranks of a byte-pair encoder (``tiktoken``), which is about five times as fast as the
``tokenizers`` library on the same file. Texts that contain one of the file's special tokens go to ``tokenizers``, and
so do texts with very long runs of white space, on which ``tiktoken`` overflows its stack.
"""

from __future__ import annotations

import json
import re
from functools import cached_property

import numpy as np
import public_tokenizers
import tiktoken
from pyspark import Broadcast
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
_OPENED: dict[int, "Encoder"] = {}
#: Runs of white space of this length and more are left to ``tokenizers``.
_LONG_BLANK = re.compile(r"\s{10000}")
#: The vocabulary's way to split a text, and one with the same splits that ``tiktoken`` goes through faster: what cannot
#: match otherwise is not tried again, letters come first, and a blank before a word is the last alternative alone.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SAME_SPLIT = r" ?\p{L}++|'(?:[stmd]|re|ve|ll)| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves, others shifted."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in printable}
    others = [b for b in range(256) if b not in letters]
    return [letters[b] if b in letters else chr(0x100 + others.index(b)) for b in range(256)]


def token_bytes(spec: dict) -> dict[bytes, int]:
    """Ids of the vocabulary by the bytes they stand for, without special tokens."""
    to_byte = {letter: b for b, letter in enumerate(byte_letters())}
    special = {t["content"] for t in spec["added_tokens"]}
    return {bytes(map(to_byte.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in special}


class Encoder:
    def __init__(self, content: str):
        spec = json.loads(content)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.size = len({*spec["model"]["vocab"], *self.special})
        self.content = content
        pattern = _SAME_SPLIT if public_tokenizers.PATTERN == _SPLIT else public_tokenizers.PATTERN
        self.fast = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=token_bytes(spec), special_tokens={})

    def _library(self) -> Tokenizer:
        made = Tokenizer.from_str(self.content)
        made.no_truncation()
        made.no_padding()
        return made

    # few texts need either: a worker that meets none keeps one vocabulary in memory, not three

    @cached_property
    def whole(self) -> Tokenizer:
        return self._library()

    @cached_property
    def plain(self) -> Tokenizer:
        made = self._library()
        made.encode_special_tokens = True
        return made

    def ids(self, text: str) -> np.ndarray:
        """Ids of a whole text; strings of special tokens in it become those tokens."""
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.plain_ids(text)

    def plain_ids(self, text: str) -> np.ndarray:
        """Ids of a whole text in which the strings of special tokens are text like any other."""
        if len(text) < 10_000 or _LONG_BLANK.search(text) is None:
            try:
                return np.array(self.fast.encode_ordinary(text), np.uint32)
            except BaseException as failure:  # a panic of the native code is no Exception
                if type(failure).__name__ != "PanicException":
                    raise
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)


def share(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The vocabulary file for the executors, which need not have it; a few MB whatever the data."""
    with open(path or VOCABULARY, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def opened(shared: Broadcast) -> Encoder:
    """The encoder of a shared vocabulary, built once in a Python worker."""
    content = shared.value
    key = hash(content)
    if key not in _OPENED:
        _OPENED.clear()
        _OPENED[key] = Encoder(content)
    return _OPENED[key]

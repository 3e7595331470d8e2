"""Ids of white-space words under a lower-casing BPE with word ends, equal to the tokenizers library's.

The vocabulary file's pre-tokenizer never joins characters over white space, so a text's ids are
those of its words one after the other, and only distinct words need encoding. Words of printable
ASCII and Latin-1 letters take a fast way: the merge ranks go into a byte-level encoder, where byte 0
stands for the word end and joining it to the last byte comes before any other merge. All other
words go through the library itself.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import regex

_LOADED: dict[str, WordBpe] = {}

#: Fixed value: the vocabulary file's own split pattern.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_PLAIN = regex.compile(r"[!-~À-ÖØ-öø-ÿ]+")


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte, the other way round."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class WordBpe:
    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters, end = byte_letters(), model["end_of_word_suffix"]

        def raw(token: str) -> bytes:
            body = token.removesuffix(end)
            return bytes(letters[c] for c in body) + b"\0" * (body != token)

        ranks = {bytes([b]): b for b in range(256)}
        for b in range(1, 256):
            ranks[bytes([b, 0])] = len(ranks)
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            ranks.setdefault(raw(a + b), len(ranks))
        self.id_of = np.zeros(len(ranks), np.int64)
        for token, number in model["vocab"].items():
            if all(c in letters for c in token.removesuffix(end)) and (rank := ranks.get(raw(token))) is not None:
                self.id_of[rank] = number
        self.fast = tiktoken.Encoding("words", pat_str=r"[^\x00\n]+\x00|\n", mergeable_ranks=ranks, special_tokens={})
        self.library = Tokenizer.from_file(path)

    @classmethod
    def load(cls, path: str) -> WordBpe:
        """One for each worker process and path."""
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(lengths, starts, ids): word ``i`` has ``ids[starts[i]:starts[i] + lengths[i]]``."""
        words = words.to_pylist()
        plain = [bool(_PLAIN.fullmatch(w)) and "<|" not in w for w in words]
        fast, odd = [w for w, p in zip(words, plain) if p], [w for w, p in zip(words, plain) if not p]
        lengths = np.zeros(len(words), np.int64)
        mask = np.array(plain, dtype=bool)
        ids = np.zeros(0, np.int64)
        if fast:
            marked = _SPLIT.sub("\\g<0>\0", "\n".join(fast).lower()) + "\n"
            got = self.fast.encode_to_numpy(marked)
            ends = np.flatnonzero(got == 10)
            lengths[mask] = np.diff(ends, prepend=-1) - 1
            ids = self.id_of[got[got != 10]]
        starts = np.zeros(len(words), np.int64)
        starts[mask] = np.cumsum(lengths[mask]) - lengths[mask]
        if odd:
            rest = [e.ids for e in self.library.encode_batch_fast(odd, add_special_tokens=False)]
            lengths[~mask] = [len(x) for x in rest]
            starts[~mask] = len(ids) + np.cumsum(lengths[~mask]) - lengths[~mask]
            ids = np.concatenate([ids, np.array([i for x in rest for i in x], np.int64)])
        return lengths, starts, ids

"""Exact byte-level BPE token counts at every prefix of a text, by dynamic programming.

A string's encoding is the one chain of tokens in which every neighbouring pair is stable, that is,
merging would not have crossed the border between the two. So the encoding of a longer prefix is that
of a shorter one plus one token, and going over start positions from left to right, each with its
last token known, fills in the last token and the count of every prefix. Nothing is encoded again to
ask how many tokens a cut text has or where a budget ends.

The pre-tokenizer's pattern starts anew where white space follows other characters, so a text is a
row of chunks (white space, then what is not); chunks repeat and each distinct one is worked out once.
"""

from __future__ import annotations

import json
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import plain_strings, text_slices, workers_import_package
from .wordbpe import byte_letters

#: White space of the pre-tokenizer, its pattern and the vocabulary's special string.
_WS = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
_SPLIT = regex.compile(_PATTERN)
_CHUNK = regex.compile(rf"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_SPECIAL = "<|endoftext|>"
#: Texts in which only single spaces and line ends part the words can be split by Arrow.
_NOT_SIMPLE = r"^ |[ \n][ \n]|[ \n]$|[\t\x0b\x0c\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|<\|endoftext\|>"
#: Bytes of counts that a worker keeps of chunks and of pre-tokens, pairs of tokens, and the longest text kept.
KEPT_BYTES, KEPT_PAIRS, LONGEST_KEPT = 160 << 20, 1_000_000, 64

_LOADED: dict[str, PrefixCounter] = {}


class _Kept(dict):
    """Counts by text, for short texts; all go when they would take more than ``KEPT_BYTES``."""

    def __init__(self):
        super().__init__()
        self.size = 0

    def keep(self, text, counts) -> None:
        if len(text) > LONGEST_KEPT:
            return
        cost = 200 + 2 * len(text) + 8 * len(counts)  # about what both objects and their entry take
        if self.size + cost > KEPT_BYTES:
            self.clear()
            self.size = 0
        self[text] = counts
        self.size += cost


class PrefixCounter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = byte_letters()
        number = {t: i for t, i in model["vocab"].items() if t != _SPECIAL}
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            if a + b in number:
                pair = number[a], number[b]
                self.merged[pair] = rank, number[a + b]
                self.parts.setdefault(number[a + b], pair)
        self.rank = {t: self.merged[p][0] for t, p in self.parts.items()}
        #: node by node: the byte's next node, and at -1 the token that ends there
        self.tree: dict = {}
        for token, i in number.items():
            node = self.tree
            for c in token:
                node = node.setdefault(letters[c], {})
            node[-1] = i
        #: whole characters with the byte after them, as they stand in tokens
        self.char_and_next = set()
        for token in number:
            raw = bytes(letters[c] for c in token)
            for i, byte in enumerate(raw):
                size = 1 + (byte >= 0xC0) + (byte >= 0xE0) + (byte >= 0xF0)
                if i + size < len(raw):
                    self.char_and_next.add(raw[i:i + size + 1])
        self.char_before = {held[:-1] for held in self.char_and_next}
        self.crossing: dict[tuple[str, int], bool] = {}
        #: by character: 1 if no token goes on after it, -1 if one may, 0 if not looked at yet; its tokens on its own
        self.closed, self.alone = np.zeros(0x110000, np.int8), np.zeros(0x110000, np.uint8)
        self.stable: dict[tuple[int, int], bool] = {}
        self.pieces, self.parts_of, self.chunks = _Kept(), _Kept(), _Kept()

    @classmethod
    def load(cls, path: str) -> PrefixCounter:
        """One for each worker process and path."""
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def _is_stable(self, left: int, right: int) -> bool:
        """Whether merging a text of the tokens ``left`` and ``right`` ends with these two.

        Undo the merges of both from the latest back to single bytes. Whenever the border's two
        neighbours could merge, that merge must come after (for the left side, not before) the one
        just undone, or it would have been done first.
        """
        asked = left, right
        known = self.stable.get(asked)
        if known is not None:
            return known
        out, never = True, 1 << 60
        # rank under which a merge over the border is early enough to happen
        limit, ties = never, False
        while True:
            over = self.merged.get((left, right))
            if over is not None and (over[0] < limit or ties and over[0] == limit):
                out = False
                break
            a, b = self.rank.get(left, -1), self.rank.get(right, -1)
            if a < 0 and b < 0:
                break
            if a > b:  # undone last: the left token's merge; of equal pairs the leftmost goes first
                limit, ties, left = a, False, self.parts[left][1]
            else:
                limit, ties, right = b, True, self.parts[right][0]
        if len(self.stable) >= KEPT_PAIRS:
            self.stable.clear()
        self.stable[asked] = out
        return out

    def prefixes(self, piece: bytes) -> list[int]:
        """Token count of ``piece[:i]`` for every i, as one pre-token."""
        n = len(piece)
        count, last = [0] * (n + 1), [-1] * (n + 1)
        tree, stable, is_stable = self.tree, self.stable, self._is_stable
        for i in range(n):
            before, node, more = last[i], tree, count[i] + 1
            for j in range(i, n):
                node = node.get(piece[j])
                if node is None:
                    break
                token = node.get(-1)
                if token is None or last[j + 1] >= 0:
                    continue
                if i:
                    fits = stable.get((before, token))
                    if fits is None:
                        fits = is_stable(before, token)
                    if not fits:
                        continue
                last[j + 1], count[j + 1] = token, more
        return count

    def _crosses(self, char: str, lead: int) -> bool:
        """Whether a token can hold the end of ``char`` and the first byte ``lead`` of the next character."""
        raw = char.encode()
        if raw + bytes([lead]) in self.char_and_next:
            return True
        for begin in range(len(raw)):  # a token that starts inside or at the character
            node = self.tree
            for byte in (*raw[begin:], lead):
                node = node.get(byte)
                if node is None:
                    break
            else:
                return True
        return False

    def _by_part(self, piece: str) -> list[int]:
        """As :meth:`_by_char`, for a long pre-token: part by part where no token crosses from one character to the next.

        No merge ever joins two tokens there, so the parts are encoded as if they stood alone.
        """
        code = np.frombuffer(piece.encode("utf-32-le"), "<u4").astype(np.int64)
        for c in np.unique(code[self.closed[code] == 0]).tolist():
            self.closed[c] = -1 if self._may_cross(chr(c)) else 1
            self.alone[c] = min(self._at_chars(chr(c), self.prefixes(chr(c).encode()))[-1], 255)
        cut = self.closed[code] > 0  # after the character
        for at in np.flatnonzero(~cut[:-1]).tolist():
            pair = piece[at], piece[at + 1].encode()[0]
            known = self.crossing.get(pair)
            if known is None:
                if len(self.crossing) >= KEPT_PAIRS:
                    self.crossing.clear()
                known = self.crossing[pair] = self._crosses(*pair)
            cut[at] = not known
        begins = np.flatnonzero(np.concatenate(([True], cut[:-1])))  # first characters of the parts
        ends = np.append(begins[1:], len(code))
        added = self.alone[code].astype(np.int64)  # tokens that each character adds to its prefix
        for begin, end in zip(begins[ends - begins > 1].tolist(), ends[ends - begins > 1].tolist()):
            added[begin:end] = np.diff(self._of_part(piece[begin:end]), prepend=0)
        return np.cumsum(added).tolist()

    def _may_cross(self, char: str) -> bool:
        """Whether some next character can share a token with the end of ``char``."""
        raw = char.encode()
        if raw in self.char_before:
            return True
        for begin in range(len(raw)):
            node = self.tree
            for byte in raw[begin:]:
                node = node.get(byte)
                if node is None:
                    break
            else:
                if any(0 <= byte < 0x80 or byte >= 0xC0 for byte in node):
                    return True
        return False

    def _of_part(self, part: str) -> list[int]:
        known = self.parts_of.get(part)
        if known is None:
            known = self._at_chars(part, self.prefixes(part.encode()))
            self.parts_of.keep(part, known)
        return known

    @staticmethod
    def _at_chars(piece: str, count: list[int]) -> list[int]:
        """Counts at the ends of characters, of counts at all bytes."""
        if len(count) == len(piece) + 1:
            return count[1:]
        known, end = [], 0
        for c in piece:
            end += len(c.encode())
            known.append(count[end])
        return known

    def _by_char(self, piece: str) -> list[int]:
        """Token counts after each character of one pre-token."""
        known = self.pieces.get(piece)
        if known is not None:
            return known
        if len(piece) > LONGEST_KEPT:
            return self._by_part(piece)
        known = self._at_chars(piece, self.prefixes(piece.encode()))
        self.pieces.keep(piece, known)
        return known

    def chunk(self, text: str) -> tuple[int, ...]:
        """Token counts of a chunk cut after each of its characters."""
        known = self.chunks.get(text)
        if known is not None:
            return known
        out: list[int] = []
        body = len(text) - len(text.lstrip("\t\n\x0b\x0c\r \x85\xa0                　"))
        if body:  # cut inside its white space, the chunk ends with one run of it
            out += self._by_char(text[:body])
        base, at = 0, 0
        for piece in _SPLIT.findall(text):
            counts = self._by_char(piece)
            if len(piece) == 3 and piece in ("'re", "'ve", "'ll"):  # cut, it is no contraction yet
                counts = [1, 2, counts[2]]
            skip = max(0, body - at)
            out += [base + c for c in counts[skip:]]
            base, at = base + counts[-1], at + len(piece)
        known = tuple(out)
        self.chunks.keep(text, known)
        return known

    def counts(self, text: str) -> np.ndarray:
        """Token counts of ``text`` cut after each of its characters, special strings as the library takes them."""
        out: list[int] = []
        base = 0
        segments = text.split(_SPECIAL)
        for k, segment in enumerate(segments):
            chunk = ""
            for chunk in _CHUNK.findall(segment):
                counts = self.chunk(chunk)
                out += [base + c for c in counts]
                base += counts[-1]
            if k < len(segments) - 1:  # cut inside it, the special string is ordinary text after the last chunk
                before = base - (self.chunk(chunk)[-1] if chunk else 0)
                for m in range(1, len(_SPECIAL)):
                    tail = 0
                    for c in _CHUNK.findall(chunk + _SPECIAL[:m]):
                        tail += self.chunk(c)[-1]
                    out.append(before + tail)
                base += 1
                out.append(base)
        return np.array(out, np.int64)

    def within(self, text: str, limit: int) -> tuple[int, int]:
        """(tokens of the text, characters of its longest prefix of at most ``limit`` tokens)."""
        counts = self.counts(text)
        fits = np.flatnonzero(counts <= limit)
        return (int(counts[-1]) if len(counts) else 0), (int(fits[-1]) + 1 if len(fits) else 0)


def _count_slice(counter: PrefixCounter, texts: pa.Array, limit: int) -> tuple[np.ndarray, np.ndarray]:
    n_tokens, keep = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    odd = pc.match_substring_regex(texts, _NOT_SIMPLE).to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(odd):
        n_tokens[i], keep[i] = counter.within(texts[int(i)].as_py(), limit)
    rows = np.flatnonzero(~odd & (pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0))
    if not len(rows):
        return n_tokens, keep
    lists = pc.split_pattern(pc.replace_substring(texts.take(pa.array(rows)), "\n", " \n"), " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    flat = lists.flatten()
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    words = [w if w.startswith("\n") else " " + w for w in coded.dictionary.to_pylist()]
    total, chars = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    first = offsets[:-1].copy()
    lead = first[offsets[1:] > offsets[:-1]]
    inner = np.ones(len(codes), bool)
    inner[lead] = False
    for k in np.unique(codes[inner]).tolist():
        counts = counter.chunk(words[k])
        total[k], chars[k] = counts[-1], len(counts)
    per, size = total[codes], chars[codes]
    heads = []
    for at in lead.tolist():  # a text's first chunk has no space before it
        head = words[codes[at]].removeprefix(" ")
        got = counter.chunk(head) if head else ()
        heads.append(np.array(got, np.int32))
        per[at], size[at] = (got[-1] if got else 0), len(got)
    tokens, ends = np.concatenate(([0], np.cumsum(per))), np.concatenate(([0], np.cumsum(size)))
    for k, (a, b) in enumerate(pairwise(offsets.tolist())):
        i, base = rows[k], tokens[a]
        n_tokens[i] = tokens[b] - base
        # the last chunk that starts within the limit holds the cut
        at = int(np.searchsorted(tokens[a:b], base + limit, side="right")) + a - 1
        inside = heads[k] if at == a else counter.chunk(words[codes[at]])
        room = limit - int(tokens[at] - base)
        keep[i] = ends[at] - ends[a] + int((np.flatnonzero(np.asarray(inside, np.int64) <= room)[-1:] + 1).sum())
    return n_tokens, keep


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, keep_chars) of every row of ``docs`` (doc_id, text).

    ``keep_chars``: characters of the longest prefix of at most ``limit`` tokens. A null text counts
    as empty: no bytes, no tokens. Rows are independent, so repeated rows and null ids stay as they are.
    """
    workers_import_package(docs.sparkSession)

    def count(batches):
        counter = PrefixCounter.load(tokenizer)
        for part in text_slices(batches):
            texts = plain_strings(part.column("text"))
            n_tokens, keep = _count_slice(counter, texts, limit)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(n_tokens),
                 pa.array(n_tokens > limit), pa.array(keep)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "keep_chars"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, keep_chars long")


def prefix_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, counts): the token count of the text cut after each of its characters; null or empty: no counts."""
    workers_import_package(docs.sparkSession)

    def count(batches):
        counter = PrefixCounter.load(tokenizer)
        for part in text_slices(batches, most=1 << 20):
            counts = [counter.counts(t) for t in plain_strings(part.column("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts, pa.list_(pa.int64()))],
                                             ["doc_id", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        count, "doc_id long, counts array<long>")

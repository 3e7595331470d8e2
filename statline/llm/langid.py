"""Language of whole texts from unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is
the sum over all ways to cut it into pieces, which a forward pass gives without listing them; a text's
is the product over its words, as no piece crosses white space. Piece probabilities come from a few
rounds of expectation maximisation (forward and backward pass) over the words of labelled documents.
Both passes go over whole words, however long: they hold ``BLOCK`` characters at once and carry the last
``LONGEST_PIECE`` values, scaled, from one block to the next, in a ring where the value of a place has the
slot ``place % LONGEST_PIECE``. Few words have a long piece at a place, so these are added for those words alone.
Only distinct words of a slice are scored, all at once by array operations.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import plain_strings, saved, text_slices, workers_import_package
from .words import per_text_sum, split_words

#: Labelled documents that teach each language (the ones with the smallest hashes), and rounds of training.
DOCS_PER_LANGUAGE, ROUNDS = 600, 4
#: Longest piece; words are never cut.
LONGEST_PIECE, LONGEST_WORD = 16, sys.maxsize
#: Characters of a word that a pass holds at once, characters of all its words, and after how many values are scaled.
BLOCK, CHARS_AT_ONCE, RESCALE = 512, 640_000, 16
#: Probability of one character that no piece covers, and what every piece has at least.
UNSEEN, FLOOR = 1e-7, 1e-6
#: A text is in the language if a character is this likely (log) at least; unseen ones have -16.
FITS = -9.0
WORDS_AT_ONCE = 20_000
_START = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def usable_pieces(model_file: str) -> list[str]:
    """Lower-case pieces of a sentencepiece vocabulary with ``LONGEST_PIECE`` characters at most."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
    return sorted({p for p in pieces if p == p.lower() and 0 < len(p) <= LONGEST_PIECE})


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = max(int(lengths.max()), 1)
    return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width).astype(np.uint64), lengths


def piece_keys(pieces: list[str]) -> np.ndarray:
    out = np.empty(len(pieces), np.uint64)
    by_length: dict[int, list[int]] = {}
    for i, p in enumerate(pieces):
        by_length.setdefault(len(p), []).append(i)
    for length, at in by_length.items():
        chars, _ = _matrix([pieces[i] for i in at])
        key = np.zeros(len(at), np.uint64)
        for c in range(length):
            key = (key + chars[:, c] + np.uint64(1)) * _BASE
        out[at] = key
    return out


def _pieces_at(chars: np.ndarray, keys: np.ndarray) -> list[np.ndarray]:
    """For each piece length, the number of the piece that starts at each character, or -1."""
    out, width = [], chars.shape[1]
    key, filled = np.zeros(chars.shape, np.uint64), chars > 0
    for length in range(1, min(LONGEST_PIECE, width) + 1):
        n = width - length + 1
        key = (key[:, :n] + chars[:, length - 1:length - 1 + n] + np.uint64(1)) * _BASE
        inside = filled[:, length - 1:length - 1 + n]  # the piece would end inside the word
        asked = key[inside]
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        found = np.full(key.shape, -1, np.int64)
        found[inside] = np.where(keys[at] == asked, at, -1)
        out.append(found)
    return out


def _groups(words: list[str]):
    """Numbers of words of like length, at most ``WORDS_AT_ONCE`` and about ``CHARS_AT_ONCE`` characters, one word at least."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    ends = np.cumsum(lengths[order])
    at = 0
    while at < len(order):
        most = np.searchsorted(ends, (ends[at - 1] if at else 0) + CHARS_AT_ONCE, side="right")
        to = max(at + 1, min(at + WORDS_AT_ONCE, int(most)))
        yield order[at:to], lengths[order[at:to]]
        at = to


def _block(words: list[str], begin: int, end: int, keys: np.ndarray) -> list[np.ndarray]:
    """Pieces found in the characters ``begin`` to ``end`` of each word; those past its end are 0, which no piece has."""
    return _pieces_at(_matrix([w[begin:end] for w in words])[0], keys)


def _chance(found: list[np.ndarray], length: int, rows: slice, at: int, probability: np.ndarray):
    """(words, their pieces, probabilities): the pieces of ``length`` that start at ``at``, words counted from ``rows``.

    All words have a piece of one character; without one in the vocabulary it has ``UNSEEN``.
    """
    if length > len(found) or at >= found[length - 1].shape[1]:
        return None  # it would end after the longest word
    piece = found[length - 1][rows, at]
    if length == 1:
        return slice(None), piece, np.where((piece < 0)[:, None], UNSEEN, probability[piece])
    some = np.flatnonzero(piece >= 0)
    if not len(some):
        return None
    if 2 * len(some) > len(piece):
        return slice(None), piece, probability[piece]
    return some, piece[some], probability[piece[some]]


def _rescale(window: np.ndarray, log: np.ndarray) -> None:
    """Divide by the largest value of the window (words, places, languages), which goes to ``log``."""
    top = window.max(axis=1)
    top[top <= 0] = 1.0
    window /= top[:, None]
    log += np.log(top)


def _advance(window, log, found, begin, base, to, lengths, probability, whole=None, keep=None):
    """Forward from place ``begin`` to ``to``; ``window`` is the ring of the last ``LONGEST_PIECE`` places' values.

    ``found`` starts at character ``base``. A word's last value goes to ``whole`` (log); ``keep`` gets (value, log) of
    every place before its step. Words are in order of length, and those that have ended are left alone.
    """
    for place in range(begin, to):
        if keep is not None:
            keep.append((window[:, place % LONGEST_PIECE].copy(), log.copy()))
        live = slice(int(np.searchsorted(lengths, place, side="right")), None)
        value = np.zeros_like(window[live, 0])
        for length in range(1, min(LONGEST_PIECE, place + 1) + 1):
            got = _chance(found, length, live, place + 1 - length - base, probability)
            if got is not None:
                some, _, p = got
                value[some] += window[live, (place + 1 - length) % LONGEST_PIECE][some] * p
        window[live, (place + 1) % LONGEST_PIECE] = value
        if whole is not None:
            done = slice(live.start, int(np.searchsorted(lengths, place + 1, side="right")))
            whole[done] = np.log(window[done, (place + 1) % LONGEST_PIECE]) + log[done]
        if (place + 1) % RESCALE == 0:
            _rescale(window[live], log[live])


def _start(words: int, languages: int) -> tuple[np.ndarray, np.ndarray]:
    window = np.zeros((words, LONGEST_PIECE, languages))
    window[:, 0] = 1.0
    return window, np.zeros((words, languages))


def word_scores(words: list[str], keys: np.ndarray, probability: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language; ``keys`` sorted, ``probability`` by key with a last row of 0."""
    marked = [_START + w for w in words]
    out = np.zeros((len(words), probability.shape[1]))
    for some, lengths in _groups(marked):
        window, log = _start(len(some), probability.shape[1])
        whole = np.zeros_like(log)
        for begin in range(0, int(lengths[-1]), BLOCK):
            live = int(np.searchsorted(lengths, begin, side="right"))
            base, end = max(begin - LONGEST_PIECE + 1, 0), min(begin + BLOCK, int(lengths[-1]))
            found = _block([marked[i] for i in some[live:]], base, end, keys)
            _advance(window[live:], log[live:], found, begin, base, end, lengths[live:], probability, whole[live:])
        out[some] = whole
    return out


def _expectation(words: list[str], weight: np.ndarray, keys: np.ndarray, probability: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the weighted words, for one language."""
    uses = np.zeros(len(keys) + 1)
    for some, lengths in _groups(words):
        longest = int(lengths[-1])
        window, log = _start(len(some), 1)
        whole, borders = np.zeros_like(log), []
        texts = [words[i] for i in some]
        for begin in range(0, longest, BLOCK):  # forward, where only the values at the borders of blocks stay
            live = int(np.searchsorted(lengths, begin, side="right"))
            borders.append((window[live:].copy(), log[live:].copy()))
            base, end = max(begin - LONGEST_PIECE + 1, 0), min(begin + BLOCK, longest)
            _advance(window[live:], log[live:], _block(texts[live:], base, end, keys), begin, base, end, lengths[live:],
                     probability, whole[live:])
        after, after_log = np.zeros((len(some), LONGEST_PIECE, 1)), np.zeros((len(some), 1))  # ring of the next places
        for begin in range((longest - 1) // BLOCK * BLOCK, -1, -BLOCK):  # backward, with each block's forward values again
            live = int(np.searchsorted(lengths, begin, side="right"))
            base, end = max(begin - LONGEST_PIECE + 1, 0), min(begin + BLOCK, longest)
            found = _block(texts[live:], base, min(end + LONGEST_PIECE - 1, longest), keys)
            (window, log), kept = borders.pop(), []
            _advance(window, log, found, begin, base, end, lengths[live:], probability, None, kept)
            for place in range(end - 1, begin - 1, -1):
                at = int(np.searchsorted(lengths, place, side="right"))
                ending = slice(at, int(np.searchsorted(lengths, place + 1, side="right")))
                after[ending, (place + 1) % LONGEST_PIECE] = 1.0
                rows, here = slice(at - live, None), np.zeros((len(some) - at, 1))
                alpha, alpha_log = (x[rows] for x in kept[place - begin])
                share = alpha * np.exp(alpha_log + after_log[at:] - whole[at:]) * weight[some[at:], None]
                for length in range(1, LONGEST_PIECE + 1):
                    got = _chance(found, length, rows, place - base, probability)
                    if got is not None:
                        words_at, piece, p = got
                        p = p * after[at:, (place + length) % LONGEST_PIECE][words_at]
                        here[words_at] += p
                        uses += np.bincount(piece % len(uses), (share[words_at] * p)[:, 0], len(uses))
                after[at:, place % LONGEST_PIECE] = here
                if place % RESCALE == 0:
                    _rescale(after[at:], after_log[at:])
    return uses[:-1]


def _train(model_file: str):
    def train(counts: pd.DataFrame) -> pd.DataFrame:
        pieces = usable_pieces(model_file)
        keys = piece_keys(pieces)
        order = np.argsort(keys)
        keys = keys[order]
        counts = counts.sort_values("word")  # sums of floats in one order, so reruns agree
        marked = (_START + counts["word"]).tolist()
        weight = counts["n"].to_numpy(np.float64)
        p = np.full(len(keys), 1.0 / len(keys))
        for _ in range(ROUNDS):
            uses = _expectation(marked, weight, keys, np.append(p, 0.0)[:, None]) + FLOOR
            p = uses / uses.sum()
        p = np.maximum(p, FLOOR / 10)
        some = p > FLOOR / 10
        return pd.DataFrame({"lang": counts["lang"].iloc[0], "piece": np.array(pieces)[order][some], "p": p[some]})

    return train


@dataclass
class LanguageModel:
    """Piece probabilities by language; its size is bounded by the vocabulary times the languages."""

    languages: list[str]
    keys: np.ndarray
    probability: np.ndarray
    spark: object = None

    @classmethod
    def fit(cls, docs: DataFrame, model_file: str | None = None, docs_per_language: int = DOCS_PER_LANGUAGE):
        """Learn from text and non-null lang of rows whose crc32(doc_id) mod 4 is not 2 and whose text isn't null.

        Each language's ``docs_per_language`` rows with the smallest hashes teach it. Without any such
        row there is no language, and every text gets ``und``.
        """
        from .queries import tokenizer_path

        spark = docs.sparkSession
        workers_import_package(spark)
        model_file = model_file or tokenizer_path("piece_bpe_32k.model")
        taught = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(False))
        # a share of each language's hash range holds about four times the bound; of these the smallest hashes teach
        part = F.shiftrightunsigned(F.xxhash64("doc_id"), 1).cast("double") / float(1 << 63)
        rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & taught)
        sizes = saved(rows.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("n")), "langid-sizes")
        place = F.row_number().over(Window.partitionBy("lang").orderBy("part", "text"))
        chosen = (rows.select("lang", "text", part.alias("part")).join(sizes, F.col("lang") == F.col("of"))
                  .where(F.col("part") * F.col("n") <= 4 * docs_per_language)
                  .withColumn("place", place).where(F.col("place") <= docs_per_language))
        words = (chosen.select("lang", F.explode(F.split(F.lower("text"), r"[ \t-\r]+")).alias("word"))
                 .where(F.length("word") > 0).groupBy("lang", "word").agg(F.count("*").alias("n")))
        learned = words.groupBy("lang").applyInPandas(_train(model_file), "lang string, piece string, p double").toPandas()
        languages = sorted(learned["lang"].unique())
        pieces = sorted(learned["piece"].unique())
        keys = piece_keys(pieces) if pieces else np.zeros(0, np.uint64)
        order = np.argsort(keys)
        table = np.zeros((len(pieces) + 1, len(languages)))
        if pieces:
            place = {pieces[i]: k for k, i in enumerate(order)}
            table[:-1] = FLOOR / 10
            column = {g: k for k, g in enumerate(languages)}
            table[learned["piece"].map(place), learned["lang"].map(column)] = learned["p"]
        return cls(languages, keys[order], table, spark)

    def _score(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, its share of the likelihood, mean log likelihood of a character) of each text."""
        letters = pc.match_substring_regex(texts, r"\pL").to_numpy(zero_copy_only=False)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), np.full(len(texts), -np.inf)
        offsets, codes, words = split_words(pc.utf8_lower(texts))
        words = words.to_pylist()
        scores = word_scores(words, self.keys, self.probability) if words else np.zeros((0, len(self.languages)))
        chars = np.fromiter(map(len, words), np.int64, len(words)) + 1
        total, n = per_text_sum(scores[codes], offsets), per_text_sum(chars[codes], offsets)
        best = total.argmax(axis=1)
        top = total[np.arange(len(total)), best]
        share = 1.0 / np.exp(total - top[:, None]).sum(axis=1)
        lang = [self.languages[b] if ok else "und" for b, ok in zip(best, letters)]
        return lang, np.where(letters, share, 0.0), np.where(letters, top / np.maximum(n, 1), -np.inf)

    def predict(self, text: Column) -> Column:
        """Struct of lang_pred, score (0 to 1) and fit of a text column; null or letterless: ``und``, 0."""
        shared = self.spark.sparkContext.broadcast((self.languages, self.keys, self.probability))
        kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("fit", pa.float64())])

        def score(texts: pa.Array) -> pa.Array:
            model, out = LanguageModel(*shared.value), [[], [], []]
            for part in text_slices([pa.RecordBatch.from_arrays([texts], ["text"])]):
                for have, got in zip(out, model._score(plain_strings(part.column(0)))):
                    have.extend(got)
            return pa.StructArray.from_arrays([pa.array(o, f.type) for o, f in zip(out, kind)], fields=list(kind))

        return F.arrow_udf(score, "lang_pred string, score double, fit double")(text)

    def accepts(self, text: Column) -> Column:
        """Whether a text is in one of the languages: it has a letter and its characters fit."""
        got = self.predict(text)
        return (got["lang_pred"] != "und") & (got["fit"] >= FITS)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs``; a null doc_id is not held out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"),
                        model.predict(F.col("text")).alias("got"))
            .select("doc_id", "held_out", "got.lang_pred", "got.score"))

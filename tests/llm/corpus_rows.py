"""Small documents with every kind of odd row, for the corpus operators' tests."""

import random
import zlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names operators use inside.
CLASH = ("size", "key", "h", "n", "rank", "score", "bucket", "shard", "kept", "text_hash", "row", "copy", "target")


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def odd_rows():
    """Nulls in any column, empty, blank, very long and repeated texts, special strings, odd characters."""
    long_text = words(1, 12_000)
    base = words(2, 120)
    rows = [
        (0, base, "en", "a", 1), (1, base, "en", "a", 1), (2, base + " tail", "en", "b", 1),
        (3, "", "en", "b", 0), (4, None, "en", "b", None), (5, "  \n\t ", None, None, 3), (6, "one", "en", None, 3),
        (7, "one", "en", "c", 3), (8, long_text, "en", "c", 9), (9, long_text + " more", "en", "c", 9),
        (10, "É́ßİ ﬁ 中文 123 don't we'll '' a  b\n\nc\x1c d <|endoftext|> x<|endo <|startoftext|>", "de", "c", 9),
        (11, "x" * 5000, "en", "c", 9), (12, base.upper(), "en", "d", 1), (12, base.upper(), "en", "d", 1),
        (None, base, "en", "d", 1), (None, None, None, None, None), (13, " lead and trail \n", "fr", "e", 1),
        (14, " no-break space\u0085next", "fr", "e", 1),
    ]
    rows += [(20 + i, words(100 + i, 5 + 7 * i), "en", f"s{i % 4}", 1) for i in range(40)]
    return rows


def crc(text) -> int:
    return zlib.crc32((text or "").encode())


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)

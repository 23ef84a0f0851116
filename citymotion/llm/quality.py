"""Quality rules with tokeniser fertility (operator 8).

Two public vocabularies are measured word by word (fertility is a property of words):
a piece vocabulary with byte fallback and a byte-level one.  Per text:

* ``chars_per_token``       code points of the words per piece token,
* ``byte_chars_per_token``  the same for the byte-level vocabulary,
* ``byte_share``            share of piece tokens that are byte fallbacks,
* ``token_entropy``         Shannon entropy (bits) of the text's piece tokens.

A text is rejected if one of them leaves its band.  Bands belong to a language (``lang``
column, if given) or else to the script most letters have; they are parameters.

Defined results: null or empty text has no words, so it fails the base rules and all its
measures are 0; a null or unknown language takes the script's band; repeated rows get equal
rows; columns of the input whose names clash with new ones are replaced by
``with_quality`` and never read.  The work is one pass over rows: no shuffle, no state beyond
a bounded cache of word encodings in each Python worker.
"""

from __future__ import annotations

import base64
import unicodedata
from array import array
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from citymotion.llm.common import small_batches

MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = frozenset("#*$%&|<>")
CACHE_WORDS = 600_000  # some 150 MB in a Python worker
PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.tiktoken"

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "n_tokens long, chars_per_token double, byte_chars_per_token double, byte_share double, token_entropy double, band string, kept boolean"
)


@dataclass(frozen=True)
class Band:
    """Inclusive limits; entropy has a lower one only."""

    chars: tuple[float, float]
    byte_chars: tuple[float, float]
    max_byte_share: float
    min_entropy: float


# The entropy floors sit below the lowest value that ordinary prose of 50 words or more
# showed (5.6 bits); text that repeats few words or shouts lies under 5.3.
DEFAULT_BANDS: dict[str, Band] = {
    "en": Band((1.55, 7.0), (1.55, 8.0), 0.10, 5.3),
    "de": Band((1.55, 7.0), (1.40, 8.0), 0.10, 5.3),
    "fr": Band((1.45, 7.0), (1.30, 8.0), 0.10, 5.3),
    "es": Band((1.45, 7.0), (1.30, 8.0), 0.10, 5.3),
    "latin": Band((1.30, 7.5), (1.10, 8.5), 0.15, 5.2),
    "cyrillic": Band((0.90, 6.0), (0.50, 4.0), 0.30, 5.0),
    "greek": Band((0.70, 5.0), (0.40, 4.0), 0.40, 4.8),
    "cjk": Band((0.25, 3.0), (0.25, 3.0), 0.85, 4.5),
    "other": Band((0.20, 8.0), (0.20, 8.0), 1.0, 4.0),
}


MARK = 1 << 15  # above all piece ids


class _Words(dict):
    """word -> its piece ids, then MARK + its number of byte-level tokens (in as many
    entries as that takes), as little-endian 16-bit numbers; emptied when full."""

    def __init__(self, pieces, byte_level):
        super().__init__()
        self.pieces, self.byte_level = pieces, byte_level

    def codes(self, words: list[bytes]) -> np.ndarray:
        """The entries of all ``words``, those that are new encoded together."""
        new = list({w for w in words if w not in self})
        if new:
            if len(self) + len(new) > CACHE_WORDS:
                self.clear()
                new = list(set(words))
            texts = [w.decode("utf-8") for w in new]
            for word, text, codes in zip(new, texts, self.pieces.encode(texts, num_threads=1)):
                n = len(self.byte_level.encode_ordinary(" " + text))
                while n >= MARK:
                    codes.append(2 * MARK - 1)
                    n -= MARK - 1
                codes.append(MARK + n)
                self[word] = array("H", codes).tobytes()
        return np.frombuffer(b"".join(map(self.__getitem__, words)), dtype=np.uint16)


_loaded: dict[tuple[str, str], tuple] = {}


def _vocabularies(pieces: str, byte_level: str):
    """The word encoder and which piece ids are byte fallbacks, once per worker."""
    key = (pieces, byte_level)
    if key not in _loaded:
        import sentencepiece
        import tiktoken

        sp = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(byte_level, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        bl = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        is_byte = np.array([sp.is_byte(i) for i in range(sp.vocab_size())])
        assert sp.vocab_size() <= MARK
        _loaded[key] = (_Words(sp, bl), is_byte)
    return _loaded[key]


SCRIPTS = frozenset(("latin", "cyrillic", "greek", "cjk", "other"))  # names of bands that are no languages


def script_of(text: str) -> str:
    """The script that most letters have."""
    counts: dict[str, int] = {}
    points, times = np.unique(np.frombuffer(text.encode("utf-32-le"), dtype="<u4"), return_counts=True)
    for ch, n in zip(map(chr, points.tolist()), times.tolist()):
        if ch.isalpha():
            if ch < "ɐ":
                kind = "latin"
            else:
                name = unicodedata.name(ch, "").split(" ")[0]
                kind = {"LATIN": "latin", "CYRILLIC": "cyrillic", "GREEK": "greek", "CJK": "cjk", "HIRAGANA": "cjk", "KATAKANA": "cjk", "HANGUL": "cjk"}.get(name, "other")
            counts[kind] = counts.get(kind, 0) + n
    return max(sorted(counts), key=counts.get) if counts else "other"


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three words that occurs at least twice in the text."""
    if len(words) < 4:
        return 0
    first: dict[bytes, int] = {}  # a word's number is where it first stands
    ids = np.fromiter(map(first.setdefault, words, count()), dtype=np.int64, count=len(words))
    pair = ids[:-1] * len(words) + ids[1:]
    if len(words) >= 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]
    triple = pair[:-1] * len(words) + ids[2:]
    order = np.argsort(triple)
    same = np.diff(triple[order]) == 0
    if not same.any():
        return 0
    covered = np.zeros(len(words), dtype=bool)
    starts = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]
    for k in range(3):
        covered[starts + k] = True
    return int(covered.sum())


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


def measure(text: str | None, lang: str | None, pieces: str, byte_level: str, bands: dict[str, Band]) -> tuple:
    """One text's row of ``FIELDS``."""
    text = text or ""
    raw = text.encode("utf-8")
    words = raw.split()  # bytes.split: exactly the white space \x20 \x09-\x0D
    n = len(words)
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8"))
    symbols = sum(map(text.count, SYMBOLS))
    repeats = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * n
    encoded, is_byte = _vocabularies(pieces, byte_level)
    codes = np.sort(encoded.codes(words))
    tokens = int(np.searchsorted(codes, MARK))
    ids, marks = codes[:tokens], codes[tokens:]
    if tokens:
        n_byte_level = int(marks.sum(dtype=np.int64)) - MARK * len(marks)
        counts = np.diff(np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1], [True]))))
        entropy = float(np.log2(tokens) - (counts * np.log2(counts)).sum() / tokens)
        cpt, bcpt, share = chars / tokens, chars / n_byte_level, float(is_byte[ids].mean())
    else:
        entropy = cpt = bcpt = share = 0.0
    name = lang if lang in bands and lang not in SCRIPTS else script_of(text)
    band = bands.get(name) or bands["other"]
    kept = (
        not failed
        and band.chars[0] <= cpt <= band.chars[1]
        and band.byte_chars[0] <= bcpt <= band.byte_chars[1]
        and share <= band.max_byte_share
        and entropy >= band.min_entropy
    )
    return n, chars, symbols, duplicate_lines(raw), repeats, failed, tokens, cpt, bcpt, share, entropy, name, kept


def quality(text: Column, lang: Column, pieces: str | None = None, byte_level: str | None = None, bands: dict[str, Band] | None = None) -> Column:
    """A struct of ``FIELDS`` for each row."""
    pieces = pieces or public_tokenizers.path(PIECES)
    byte_level = byte_level or public_tokenizers.path(BYTES)
    bands = bands or DEFAULT_BANDS
    names = [x.strip().split(" ")[0] for x in FIELDS.split(",")]

    @pandas_udf(FIELDS)
    def measured(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
        rows = [measure(t, g, pieces, byte_level, bands) for t, g in zip(texts, langs)]
        return pd.DataFrame(rows, columns=names)

    return measured(text, lang)


def with_quality(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (text, optionally lang) with the measures and ``kept`` as further columns."""
    small_batches(docs.sparkSession)
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    names = [x.strip().split(" ")[0] for x in FIELDS.split(",")]
    q = docs.withColumn("__quality", quality(F.col("text"), lang, **options))
    return q.withColumns({c: F.col(f"__quality.{c}") for c in names}).drop("__quality")


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    small_batches(docs.sparkSession)
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    q = docs.withColumn("__quality", quality(F.col("text"), lang, **options))
    return q.filter("__quality.kept").drop("__quality")

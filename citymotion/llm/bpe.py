"""Byte-level BPE encoding and decoding (operator 5).

Pre-tokenisation without regular expressions.  A batch of texts becomes one array of code
points; a table gives each its class (letter, number, space, other, apostrophe), which one
character of lookahead refines (a white-space character before a non-space; an apostrophe
before a contraction's letters).  Each refined class is a function from the states of a
small automaton to states; function composition is associative, so the array is cut into
equal columns, the functions of each column are composed in step, the columns' functions
are joined by a doubling scan, and a second pass marks the token boundaries.  The first
character of each text maps every state to the same one, so texts never touch.

The slices between boundaries feed pair merging by ranks through a bounded cache.  Token
byte offsets into one blob of all tokens are kept for decoding.

Code point classes are those of the tiktoken library installed (its Unicode version).

Defined results: null and empty texts have no tokens; repeated rows get equal rows; very
long texts and very long slices are merged with a heap in n log n; other columns stay.
No shuffle; a worker holds one batch of texts and a cache of at most ``CACHE_SLICES`` slices.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterable

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from citymotion.llm.common import small_batches

RANKS = "byte_bpe_multi_50k.tiktoken"
CACHE_SLICES = 500_000
CACHED_CHARS = 48
BATCH_CHARS = 1 << 21

# base classes of code points
OTHER, LETTER, NUMBER, SPACE, APOSTROPHE = range(5)
# refined classes: what may follow
C_LETTER, C_NUMBER, C_OTHER, C_SHORT, C_LONG, C_SPACE, C_BLANK_LAST, C_SPACE_LAST = range(8)
# states: what the character before was
S_NEW, S_LETTER, S_NUMBER, S_OTHER, S_SPACE, S_BLANK, S_ONE_MORE, S_TWO_MORE = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """next state and 'a token begins here', by refined class (+8: first of a text) and state."""
    follow = np.zeros((16, 8), dtype=np.uint8)
    begins = np.ones((16, 8), dtype=bool)
    goes = {C_LETTER: S_LETTER, C_NUMBER: S_NUMBER, C_OTHER: S_OTHER, C_SHORT: S_ONE_MORE, C_LONG: S_TWO_MORE, C_SPACE: S_SPACE, C_BLANK_LAST: S_BLANK, C_SPACE_LAST: S_NEW}
    joins = {C_LETTER: (S_LETTER, S_BLANK), C_NUMBER: (S_NUMBER, S_BLANK), C_OTHER: (S_OTHER, S_BLANK), C_SPACE: (S_SPACE,)}
    for c, state in goes.items():
        follow[c] = state
        begins[c, list(joins.get(c, ()))] = False
    follow[C_LETTER, S_TWO_MORE], follow[C_LETTER, S_ONE_MORE] = S_ONE_MORE, S_NEW
    begins[C_LETTER, [S_TWO_MORE, S_ONE_MORE]] = False
    for c in (C_SHORT, C_LONG):  # an apostrophe after a blank or other sign is a sign itself
        follow[c, [S_OTHER, S_BLANK]] = S_OTHER
        begins[c, [S_OTHER, S_BLANK]] = False
    follow[8:] = follow[:8, S_NEW][:, None]
    return follow, begins


FOLLOW, BEGINS = _automaton()
_tables: dict[str, object] = {}


def class_table() -> np.ndarray:
    """The base class of every code point, as the tiktoken library sees them."""
    if "classes" not in _tables:
        import tiktoken

        points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
        every = "".join(map(chr, points))
        table = np.zeros(0x110000, dtype=np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
            only = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
            found = bytes(only.encode_ordinary(every)).decode("utf-8")
            table[np.frombuffer(found.encode("utf-32-le"), dtype="<u4")] = kind
        table[ord("'")] = APOSTROPHE
        _tables["classes"] = table
    return _tables["classes"]


def refined(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Refined classes of concatenated texts; ``first`` marks the first character of each."""
    base = class_table()[points]
    n = len(points)
    ends = np.ones(n, dtype=bool)  # last of its text
    ends[:-1] = first[1:]
    nxt = np.zeros(n, dtype=np.uint32)
    nxt[:-1] = points[1:]
    nxt[ends] = 0
    out = np.choose(base, (C_OTHER, C_LETTER, C_NUMBER, C_SPACE, C_OTHER)).astype(np.uint8)
    solid = np.zeros(n, dtype=bool)  # a non-space follows
    solid[:-1] = base[1:] != SPACE
    solid &= ~ends
    last = (base == SPACE) & solid
    out[last] = np.where(points[last] == ord(" "), C_BLANK_LAST, C_SPACE_LAST)
    at = np.flatnonzero(base == APOSTROPHE)
    if len(at):
        one = nxt[at]
        two = np.where(at + 1 < n, nxt[np.minimum(at + 1, n - 1)], 0)
        two[ends[at]] = 0
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        out[at[short]] = C_SHORT
        out[at[long]] = C_LONG
    out[first] += 8
    return out


def boundaries(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a token begins at each position, by a scan over transition functions."""
    n = len(points)
    if not n:
        return np.zeros(0, dtype=bool)
    width = max(16, int(np.sqrt(n / 8)))
    rows = -(-n // width)
    classes = np.zeros(rows * width, dtype=np.uint8)
    classes[:n] = refined(points, first)
    steps = np.ascontiguousarray(classes.reshape(rows, width).T)  # steps[j]: the j-th of each column
    table = FOLLOW.reshape(-1)
    whole = np.broadcast_to(np.arange(8, dtype=np.uint8), (rows, 8)).copy()
    for j in range(width):  # each column's function: all eight states at once
        whole = table[(steps[j].astype(np.intp) * 8)[:, None] + whole]
    hop = 1
    while hop < rows:  # doubling scan: whole[i] becomes the function of columns 0..i
        whole[hop:] = np.take_along_axis(whole[hop:], whole[:-hop].astype(np.intp), axis=1)
        hop *= 2
    state = np.zeros(rows, dtype=np.uint8)
    state[1:] = whole[:-1, S_NEW]
    flags = np.empty((width, rows), dtype=bool)
    begins = BEGINS.reshape(-1)
    for j in range(width):
        key = steps[j].astype(np.intp) * 8 + state
        flags[j] = begins[key]
        state = table[key]
    return flags.T.reshape(-1)[:n]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the pair of lowest rank, leftmost first, is merged until none has one."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n <= 64:
        parts = [piece[i : i + 1] for i in range(n)]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]
    end = list(range(1, n + 1))  # end[i]: end of the part that starts at i, 0 once merged away
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        j = end[i]
        if j < n:
            r = ranks.get(piece[i : end[j]])
            if r is not None:
                heapq.heappush(heap, (r, i, j, end[j]))

    while heap:
        _, i, j, k = heapq.heappop(heap)
        if end[i] != j or end[j] != k:
            continue
        end[i], end[j] = k, 0
        if k < n:
            before[k] = i
            offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Tokenizer(dict):
    """Encodes and decodes by a rank file; as a dict, the cache slice -> ids (bytes)."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, i in self.ranks.items():
            tokens[i] = token
        self.blob = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int64)
        self.known = np.array([bool(t) for t in tokens])

    def __missing__(self, piece: str) -> bytes:
        ids = array("I", merge(piece.encode("utf-8"), self.ranks)).tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHE_SLICES:
                self.clear()
            self[piece] = ids
        return ids

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        out: list[bytes] = []
        some: list[str] = []
        size = 0
        for t in texts:
            some.append(t)
            size += len(t)
            if size >= BATCH_CHARS:
                out += self._encode(some)
                some, size = [], 0
        return out + self._encode(some)

    def _encode(self, texts: list[str]) -> list[bytes]:
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        starts = np.cumsum(lengths) - lengths
        first = np.zeros(len(points), dtype=bool)
        first[starts[lengths > 0]] = True
        cuts = np.flatnonzero(boundaries(points, first))
        where = np.searchsorted(cuts, starts)
        where = np.append(where, len(cuts)).tolist()
        cuts = np.append(cuts, len(points))
        out = []
        for k, (text, start) in enumerate(zip(texts, starts.tolist())):
            own = (cuts[where[k] : where[k + 1] + 1] - start).tolist()
            out.append(b"".join([self[text[a:b]] for a, b in zip(own, own[1:])]))
        return out

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for, gathered by the offsets of all tokens."""
        tokens = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        if not len(tokens):
            return b""
        if tokens.max() >= len(self.known) or not self.known[tokens].all():
            raise ValueError("unknown token id")
        begin = self.offsets[tokens]
        length = self.offsets[tokens + 1] - begin
        shift = np.repeat(begin - (np.cumsum(length) - length), length)
        return self.blob[shift + np.arange(len(shift))].tobytes()


def tokenizer(path: str) -> Tokenizer:
    """One tokenizer per rank file in each worker."""
    if path not in _tables:
        _tables[path] = Tokenizer(path)
    return _tables[path]


def _texts(column: Iterable) -> list[str]:
    return [t if isinstance(t, str) else "" for t in column]


def encode(text: Column, path: str | None = None) -> Column:
    """Binary: the ids as little-endian unsigned 32-bit numbers."""
    path = path or public_tokenizers.path(RANKS)

    @pandas_udf("binary")
    def encoded(texts: pd.Series) -> pd.Series:
        return pd.Series(tokenizer(path).encode_batch(_texts(texts)), dtype=object)

    return encoded(text)


def decode(ids: Column, path: str | None = None) -> Column:
    """Binary: the bytes that the ids of ``encode`` stand for."""
    path = path or public_tokenizers.path(RANKS)

    @pandas_udf("binary")
    def decoded(column: pd.Series) -> pd.Series:
        t = tokenizer(path)
        return pd.Series([t.decode(bytes(x)) if x is not None else b"" for x in column], dtype=object)

    return decoded(ids)


def round_trip(text: Column, path: str | None = None) -> Column:
    """Struct (n_tokens, ids_sha256, decoded_sha256) of encoding and decoding again."""
    path = path or public_tokenizers.path(RANKS)

    @pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pd.Series) -> pd.DataFrame:
        t = tokenizer(path)
        rows = [(len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.decode(ids)).hexdigest()) for ids in t.encode_batch(_texts(texts))]
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests(text)


def with_digests(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256; clashing columns are replaced."""
    small_batches(docs.sparkSession)
    df = docs.withColumn("__bpe", round_trip(F.col(text_col), path))
    return df.withColumns({c: F.col(f"__bpe.{c}") for c in ("n_tokens", "ids_sha256", "decoded_sha256")}).drop("__bpe")


def with_ids(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with the ids of ``encode`` in ``token_ids``."""
    small_batches(docs.sparkSession)
    return docs.withColumn("token_ids", encode(F.col(text_col), path))

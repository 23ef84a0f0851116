"""Quality rules against a plain version that encodes word by word."""

import base64
import math
import re
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken

from citymotion.llm import quality as Q


@pytest.fixture(scope="module")
def plain():
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path(Q.PIECES))
    with open(P.path(Q.BYTES), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tk = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def measured(text, lang):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
        seen, dup = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        base = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated), len(words) < 50 or 100 * len(repeated) > 50 * len(words))
        ids = [i for w in words for i in sp.encode(w)]
        n = len(ids)
        if not n:
            return (*base, 0, 0.0, 0.0, 0.0, 0.0)
        entropy = -sum(c / n * math.log2(c / n) for c in Counter(ids).values())
        chars = base[1]
        return (*base, n, chars / n, chars / sum(len(tk.encode_ordinary(" " + w)) for w in words), sum(map(sp.is_byte, ids)) / n, entropy)

    return measured


EXTRA = [
    (-1, None, "en"), (-2, "", None), (-3, "one", "xx"), (-4, "a b c " * 40, "en"), (-5, "same line\nsame line\n\n \nsame line", "en"), (-6, "\x1c\x85\xa0 x y", "en"),
    (-7, " ".join(f"слово{i} текст" for i in range(60)), None), (-8, "漢字" * 3000, None), (-9, " ".join("ab#*$%&|<>"[i % 10] * (i % 7 + 1) for i in range(90)), "en"),
    (-10, "x" * 120_000, "en"), (-11, "�\x00 " * 60, "en"), (-5, "same line\nsame line\n\n \nsame line", "en"),
]


def test_measures_equal_plain_version(spark, docs_rows, plain):
    rows = docs_rows + EXTRA
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, lang string, n_words int")
    got = Q.with_quality(df).collect()
    want = {i: plain(t, g) for i, t, g in rows}
    assert len(got) == len(rows)
    for r in got:
        values = [r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_tokens", "chars_per_token", "byte_chars_per_token", "byte_share", "token_entropy")]
        assert values == pytest.approx(list(want[r["doc_id"]]), abs=1e-9), r["doc_id"]
        assert not (r["kept"] and r["base_failed"])
    assert {r["doc_id"]: r["band"] for r in got}[-7] == "cyrillic"


def test_good_documents_stay(spark):
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.01"
    good = {r["doc_id"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist() if r["quality"] == 1}
    df = Q.with_quality(spark.read.parquet(f"{sf}/documents.parquet"))
    assert [r["doc_id"] for r in df.filter("NOT kept AND NOT base_failed").collect() if r["doc_id"] in good] == []
    kept = Q.keep_good(spark.read.parquet(f"{sf}/documents.parquet"))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"] and kept.count() == df.filter("kept").count()
    assert Q.keep_good(kept.limit(0)).count() == 0


def test_script_counts_all_letters():
    assert Q.script_of(("ж" + "abc") * 400) == "latin"  # every fourth character is Cyrillic
    assert Q.script_of((" " + "где") * 400) == "cyrillic"
    assert Q.script_of("1 2 3 " * 400 + "ab") == "latin"
    assert Q.script_of("") == "other" and Q.script_of("12 \U0001f600") == "other"


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(Q, "CACHE_WORDS", 3)
    args = (P.path(Q.PIECES), P.path(Q.BYTES), Q.DEFAULT_BANDS)
    a = [Q.measure(" ".join(f"w{i}{j}" for j in range(9)), "en", *args) for i in range(5)]
    monkeypatch.setattr(Q, "CACHE_WORDS", 10**6)
    assert a == [Q.measure(" ".join(f"w{i}{j}" for j in range(9)), "en", *args) for i in range(5)]


def test_names_of_scripts_are_no_languages():
    text = "\u0441\u043b\u043e\u0432\u0430 \u0438 \u0431\u0443\u043a\u0432\u044b " * 40
    names = [Q.measure(text, lang, P.path(Q.PIECES), P.path(Q.BYTES), Q.DEFAULT_BANDS)[-2] for lang in ("other", "latin", "cjk", "xx", None)]
    assert names == ["cyrillic"] * 5

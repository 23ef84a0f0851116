"""Secret scans with a randomness test battery (operator 2); DataFrame functions only.

Base kinds (leftmost, non-overlapping per kind): ``assign``, ``access``, ``hex``.

Added kind ``random``: maximal runs of 20 or more encoding characters, base spans cut out
of them, whose encoding can be inferred (decimal, hex, base32, base36, base62, base64,
base64url; runs of plain words have none).  What has no encoding is split at the characters
foreign to base64 or to base64url, whichever leaves the longer longest part (base64 if they
are equal); words joined to a part by a separator (``path/`` before it, ``-name`` after it) are
taken off, and parts of 20 characters or more are runs too.  Runs never overlap each other or
a base span.  Each run takes three tests of the hypothesis
"drawn at random from this alphabet": chi-squared uniformity of the symbols
(Wilson-Hilferty), Wald-Wolfowitz runs about the alphabet's middle, and lag-1 serial
correlation; Fisher's method joins the three p-values.

False-discovery control is length-aware: within each (encoding, length band) over the
whole corpus, Benjamini-Hochberg at level ``q`` rejects the runs that are not random, so
that at most a share q of the rejected are keys; those that stay are reported.  A run
shorter than its encoding's ``least`` length is not reported: the battery could not have
rejected text of that length.  p-values are counted in bins of -ln p (upper edges are
compared, so the control is never looser than exact): the table behind the thresholds has
encodings x bands x bins rows at most, whatever the corpus.

Positions are code points.  They come from the gaps that ``split`` leaves between matches;
sums over blocks of 256 matches keep texts with very many matches near-linear.

Defined results: null and empty texts have no spans; repeated rows get equal rows; no
document gives no thresholds; other columns stay as they are, and those whose names
clash with the result columns are replaced.  No shuffle moves texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citymotion.llm.common import written

KINDS = ("assign", "access", "hex", "random")
Q = 0.05
BINS_PER_E = 20
MAX_BIN = 40 * BINS_PER_E
BANDS = (20, 24, 32, 48, 64, 128)  # lower ends
BLOCK = 256

# name, symbols in order, pattern of the whole run, least length
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    ("decimal", DIGITS, r"[0-9]+", 32),
    ("hex", DIGITS + "abcdef", r"(?=.*[0-9])[0-9a-f]+", 24),
    ("hexupper", DIGITS + "ABCDEF", r"(?=.*[0-9])[0-9A-F]+", 24),
    ("base32", UPPER + "234567", r"(?=.*[2-7])[A-Z2-7]+", 24),
    ("base36", DIGITS + LOWER, r"(?=.*[0-9])[0-9a-z]+", 24),
    ("base36upper", DIGITS + UPPER, r"(?=.*[0-9])[0-9A-Z]+", 24),
    ("base62", DIGITS + UPPER + LOWER, r"(?=.*[a-z][A-Z]|.*[0-9])[0-9A-Za-z]+", 22),
    ("base64", UPPER + LOWER + DIGITS + "+/", r"(?=.*[a-z][A-Z]|.*[0-9])[0-9A-Za-z+/]+", 22),
    ("base64url", UPPER + LOWER + DIGITS + "-_", r"(?=.*[a-z][A-Z]|.*[0-9])[0-9A-Za-z_-]+", 22),
)


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = r"(%s|%s|%s|%s|%s_?%s)" % tuple(map(_either, ("password", "passwd", "secret", "token", "api", "key"))) + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # what 'AKIA[A-Z0-9]+' finds, without those under 20 characters
HEX = r"[0-9a-f]{24,}"  # likewise: a maximal run is matched from its start
RUN = r"[A-Za-z0-9+/_-]{20,}"
LEAST_RUN = 20
PARTS = (r"[A-Za-z0-9+/]{20,}", r"[A-Za-z0-9_-]{20,}")
WORDS_BEFORE = r"^(?:[A-Z]?[a-z]{2,}[0-9]{0,4}[+/_-])+"
WORDS_AFTER = r"(?:[+/_-][A-Z]?[a-z]{2,}[0-9]{0,4})+$"


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _matches(text: Column, kind: int, pattern: str, value_group: int = 0) -> Column:
    """Structs (start, kind, end, token, n) of all matches; n is the length of the group."""

    def gap(m: Column, i: Column) -> Column:
        return F.char_length(m["gaps"][i]).cast("long")

    def offsets(lengths: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int"))
        return F.aggregate(blocks, F.array(F.lit(0).cast("long")), lambda acc, b: F.concat(acc, F.array(acc[b] + _sum(F.slice(lengths, b * BLOCK + 1, BLOCK)))))

    def spans(m: Column, lengths: Column, off: Column) -> Column:
        def span(h: Column, i: Column) -> Column:
            def at(block: Column) -> Column:
                start = off[block] + _sum(F.slice(lengths, block * BLOCK + 1, i % BLOCK)) + gap(m, i)
                n = F.char_length(m["values"][i]) if value_group else F.char_length(h)
                return _let(start, lambda s: F.struct(s.alias("start"), F.lit(kind).alias("kind"), (s + F.char_length(h)).alias("end"), h.alias("token"), n.alias("n")))

            return _let(F.floor(i / BLOCK).cast("int"), at)

        return F.transform(m["hits"], span)

    def all_of(m: Column) -> Column:
        lengths = F.transform(m["hits"], lambda h, i: gap(m, i) + F.char_length(h))
        return _let(lengths, lambda n: _let(offsets(n), lambda off: spans(m, n, off)))

    every = lambda group: F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = [F.split(text, pattern, -1).alias("gaps"), every(0).alias("hits")] + ([every(value_group).alias("values")] if value_group else [])
    none = F.expr("array()").cast("array<struct<start:bigint,kind:int,end:bigint,token:string,n:int>>")
    return F.when(text.rlike(pattern), _let(F.struct(*parts), all_of)).otherwise(none)


def _base(text: Column) -> Column:
    assign = F.filter(_matches(text, 0, ASSIGN, 2), lambda s: s["n"] >= 6)
    return F.array_sort(F.concat(assign, _matches(text, 1, ACCESS), _matches(text, 2, HEX)))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution for z >= 0 (fixed values of Abramowitz and
    Stegun 26.2.17); its floor keeps logarithms finite."""
    t = 1 / (1 + F.lit(0.2316419) * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.greatest(F.exp(-z * z / 2) * 0.3989422804014327 * poly, F.lit(1e-18))


def _encoding(tok: Column) -> Column:
    out = F.lit(-1)
    for i in reversed(range(len(ENCODINGS))):
        out = F.when(tok.rlike("^(?:" + ENCODINGS[i][2] + ")$"), F.lit(i)).otherwise(out)
    return out


def _scored(runs: Column) -> Column:
    """Of each usable run: start, end, stratum (encoding and length band), bin of -ln p."""
    symbols = F.array(*[F.lit(e[1]) for e in ENCODINGS])
    least = F.array(*[F.lit(e[3]) for e in ENCODINGS])
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)

    def coded(s: Column) -> Column:
        return _let(_encoding(s["token"]), lambda e: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["token"].alias("token"), e.alias("enc")))

    def values(s: Column) -> Column:
        alphabet = symbols[s["enc"]]
        v = _let(alphabet, lambda a: F.transform(F.split(s["token"], "", -1), lambda c: F.instr(a, c).cast("double") - 1))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["enc"].alias("enc"), F.char_length(alphabet).cast("double").alias("k"), v.alias("v"))

    def moments(s: Column) -> Column:
        v, k = s["v"], s["k"]

        def of(mean: Column) -> Column:
            squares = total(F.transform(F.array_distinct(v), lambda x: F.pow(F.size(F.filter(v, lambda y: y == x)).cast("double"), F.lit(2.0))))
            lagged = F.arrays_zip(F.slice(v, 1, F.size(v) - 1).alias("a"), F.slice(v, 2, F.size(v) - 1).alias("b"))
            pairs = F.aggregate(
                lagged, F.struct(F.lit(0.0).alias("changes"), F.lit(0.0).alias("cross")),
                lambda acc, p: F.struct((acc["changes"] + F.when((p["a"] >= k / 2) != (p["b"] >= k / 2), 1.0).otherwise(0.0)).alias("changes"), (acc["cross"] + (p["a"] - mean) * (p["b"] - mean)).alias("cross")),
            )
            high = total(F.transform(v, lambda x: F.when(x >= k / 2, 1.0).otherwise(0.0)))
            spread = total(F.transform(v, lambda x: (x - mean) * (x - mean)))
            return F.struct(
                s["start"].alias("start"), s["end"].alias("end"), s["enc"].alias("enc"), F.size(v).cast("double").alias("n"), k.alias("k"),
                squares.alias("sq"), high.alias("high"), pairs.alias("pairs"), spread.alias("spread"),
            )

        return _let(total(v) / F.size(v), of)

    def chi_squared(s: Column) -> Column:
        df = s["k"] - 1
        x = s["k"] / s["n"] * s["sq"] - s["n"]
        z = (F.pow(x / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        return _let(z, lambda z: F.when(z >= 0, _tail(z)).otherwise(1 - _tail(-z)))

    def runs_test(s: Column) -> Column:
        n, high = s["n"], s["high"]
        two_sided = lambda mu: _let(
            (mu - 1) * (mu - 2) / (n - 1),
            lambda var: F.when(var > 0, _let(F.abs(s["pairs"]["changes"] + 1 - mu) / F.sqrt(var), lambda z: F.least(2 * _tail(z), F.lit(1.0)))).otherwise(1.0),
        )
        one_sided = (high == 0) | (high == n)
        return F.when(one_sided, F.greatest(F.pow(F.lit(0.5), n - 1), F.lit(1e-18))).otherwise(_let(1 + 2 * high * (n - high) / n, two_sided))

    def serial(s: Column) -> Column:
        z = F.abs(s["pairs"]["cross"] / s["spread"] + 1 / s["n"]) * F.sqrt(s["n"])
        return F.when(s["spread"] > 0, _let(z, lambda z: F.least(2 * _tail(z), F.lit(1.0)))).otherwise(F.lit(1e-18))

    def tested(s: Column) -> Column:
        # -ln of Fisher's p with 6 degrees of freedom
        joint = _let(-(F.log(chi_squared(s)) + F.log(runs_test(s)) + F.log(serial(s))), lambda h: h - F.log(1 + h + h * h / 2))
        bin_ = F.least(F.floor(F.greatest(joint, F.lit(0.0)) * BINS_PER_E), F.lit(MAX_BIN)).cast("int")
        band = sum((F.when(s["n"] >= b, 1).otherwise(0) for b in BANDS[1:]), F.lit(0))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), (s["enc"] * len(BANDS) + band).alias("stratum"), bin_.alias("bin"))

    usable = F.filter(F.transform(runs, coded), lambda s: (s["enc"] >= 0) & (F.char_length(s["token"]) >= least[F.greatest(s["enc"], F.lit(0))]))
    return F.transform(usable, lambda s: _let(values(s), lambda v: _let(moments(v), tested)))


def _pieces(text: Column, base: Column) -> Column:
    """The pieces of all runs outside the base spans (sorted by start)."""
    none = F.expr("array()").cast("array<struct<start:bigint,end:bigint>>")

    def piece(token: Column, offset: Column, a: Column, z: Column) -> Column:
        return F.struct(a.alias("start"), z.alias("end"), F.substring(token, (a - offset + 1).cast("int"), (z - a).cast("int")).alias("token"))

    def outside(r: Column, base: Column) -> Column:
        span = lambda a, z: F.struct(a.alias("start"), z.alias("end"))
        cuts = F.concat(F.transform(F.filter(base, lambda b: (b["start"] < r["end"]) & (b["end"] > r["start"])), lambda b: span(b["start"], b["end"])), F.array(span(r["end"], r["end"])))
        step = lambda acc, b: F.struct(F.greatest(acc["at"], b["end"]).alias("at"), F.when(b["start"] - acc["at"] >= LEAST_RUN, F.concat(acc["out"], F.array(span(acc["at"], b["start"])))).otherwise(acc["out"]).alias("out"))
        kept = F.aggregate(cuts, F.struct(r["start"].alias("at"), none.alias("out")), step, lambda acc: acc["out"])
        return F.transform(kept, lambda k: piece(r["token"], r["start"], k["start"], k["end"]))

    return _let(base, lambda base: F.flatten(F.transform(_matches(text, 3, RUN), lambda r: outside(r, base))))


def _parts(pieces: Column) -> Column:
    """Each piece itself if it has an encoding, else its parts in the alphabet that leaves the longest."""

    def trimmed(p: Column, m: Column) -> Column:
        def of(before: Column) -> Column:
            core = F.regexp_replace(F.substring(m["token"], before + 1, F.char_length(m["token"])), WORDS_AFTER, "")
            at = lambda c: F.struct((p["start"] + m["start"] + before).alias("start"), (p["start"] + m["start"] + before + F.char_length(c)).alias("end"), c.alias("token"))
            return _let(core, at)

        return _let(F.char_length(F.regexp_extract(m["token"], WORDS_BEFORE, 0)), of)

    def split(p: Column, pattern: str) -> Column:
        return F.filter(F.transform(_matches(p["token"], 3, pattern), lambda m: trimmed(p, m)), lambda s: F.char_length(s["token"]) >= LEAST_RUN)

    longest = lambda parts: F.coalesce(F.array_max(F.transform(parts, lambda s: s["end"] - s["start"])), F.lit(0))

    def parts(p: Column) -> Column:
        both = F.struct(split(p, PARTS[0]).alias("standard"), split(p, PARTS[1]).alias("url"))
        chosen = _let(both, lambda x: F.when(longest(x["standard"]) >= longest(x["url"]), x["standard"]).otherwise(x["url"]))
        return F.when(_encoding(p["token"]) >= 0, F.array(p)).otherwise(chosen)

    return F.flatten(F.transform(pieces, parts))


def _with_runs(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with the base spans in ``__base`` and the scored runs outside them in ``__runs``, in
    steps: one expression would have too many levels for Spark's analyzer."""
    df = docs.withColumn("__base", _base(text)).withColumn("__pieces", _pieces(text, F.col("__base")))
    df = df.withColumn("__parts", _parts(F.col("__pieces")))
    return df.withColumn("__runs", _scored(F.col("__parts"))).drop("__pieces", "__parts")


def _scanned(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep``, the base spans and the scored runs, written to the shared folder:
    thresholds and spans both read them, so that the battery sees each text once."""
    df = _with_runs(docs, F.coalesce(F.col(text_col), F.lit("")))
    base = F.transform("__base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return written(df.withColumn("__base", base).select(*keep, "__base", "__runs"), "secret-runs")


def _thresholds(scanned: DataFrame, q: float) -> dict[int, int]:
    """For each (encoding, length band) the least bin that Benjamini-Hochberg rejects."""
    bins = scanned.select(F.explode("__runs").alias("r")).groupBy(F.col("r.stratum").alias("stratum"), F.col("r.bin").alias("bin")).agg(F.count("*").alias("n"))
    by = Window.partitionBy("stratum")  # at most MAX_BIN + 1 rows in each
    ranked = bins.withColumn("rank", F.sum("n").over(by.orderBy(F.desc("bin")))).withColumn("m", F.sum("n").over(by))
    edge = F.exp(-F.col("bin") / BINS_PER_E)
    passing = ranked.filter(edge <= q * F.col("rank") / F.col("m")).groupBy("stratum").agg(F.min("bin").alias("bin"))
    return {r["stratum"]: r["bin"] for r in passing.collect()}  # encodings x bands rows at most


def with_spans(docs: DataFrame, text_col: str = "text", q: float = Q, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns of ``docs`` by default) and ``secret_spans``: array of (start, kind,
    end), kind the place in KINDS, by start, then kind."""
    scanned = _scanned(docs, text_col, [c for c in keep or docs.columns if c != "secret_spans"])
    cut = _thresholds(scanned, q)
    table = F.create_map(*[F.lit(x) for kv in sorted((cut or {-1: 0}).items()) for x in kv])
    keys = F.filter("__runs", lambda r: r["bin"] < F.coalesce(F.try_element_at(table, r["stratum"]), F.lit(MAX_BIN + 1)))
    as_span = lambda s: F.struct(s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end"))
    return scanned.withColumn("secret_spans", F.array_sort(F.concat("__base", F.transform(keys, as_span)))).drop("__base", "__runs")


def _named(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = Q) -> DataFrame:
    """Per row: id, counts by kind, digest of the base spans, all spans as a string."""
    s = F.col("secret_spans")
    count = lambda k: F.size(F.filter(s, lambda x: x["kind"] == k)).cast("long")
    return with_spans(docs.select(id_col, text_col), text_col, q, [id_col]).select(
        id_col, *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_named(F.filter(s, lambda x: x["kind"] < 3)), 256).alias("base_sha256"), _named(s).alias("spans"),
    )


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None, q: float = Q) -> DataFrame:
    """``docs`` with each secret in ``text_col`` replaced by ``[kind]``; overlapping spans
    become one, named by the first.  ``length_col``, if given, is set to the new length."""
    df = with_spans(docs, text_col, q)
    text, s = F.col(text_col), F.col("secret_spans")
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int"))
        fresh = x["start"] >= acc["at"]
        out = F.when(fresh, F.concat(acc["out"], gap, F.lit("["), kinds[x["kind"]], F.lit("]"))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), out.alias("out"))

    clean = F.aggregate(s, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.lit(2147483647))))
    df = df.withColumn("__clean", F.when(F.size(s) > 0, clean)).withColumn(text_col, F.coalesce("__clean", text))
    if length_col and length_col in docs.columns:
        df = df.withColumn(length_col, F.when(F.size(s) > 0, F.char_length(text_col).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col)))
    return df.select(*docs.columns)


def oracle(source: str = "documents", q: float = Q) -> str:
    """DuckDB SQL of ``report`` (ids have to be unique)."""

    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def kind(k: int, pattern: str, group: int = 0) -> str:
        p = quoted(pattern)
        return f"""h{k} AS (
  SELECT doc_id, unnest(range(1, len(hits) + 1)) AS i, gaps, hits, vals FROM (
    SELECT doc_id, regexp_split_to_array(t, {p}) AS gaps, regexp_extract_all(t, {p}, 0) AS hits, regexp_extract_all(t, {p}, {group}) AS vals
    FROM d WHERE regexp_matches(t, {p}))),
m{k} AS (
  SELECT doc_id, {k} AS kind, CAST(length(array_to_string(gaps[1:i], '')) + length(array_to_string(hits[1:i - 1], '')) AS BIGINT) AS a, hits[i] AS token, length(vals[i]) AS n FROM h{k})"""

    def tail(z: str) -> str:
        t = f"(1 / (1 + 0.2316419 * ({z})))"
        poly = f"{t} * (0.319381530 + {t} * (-0.356563782 + {t} * (1.781477937 + {t} * (-1.821255978 + {t} * 1.330274429))))"
        return f"greatest(exp(-({z}) * ({z}) / 2) * 0.3989422804014327 * {poly}, 1e-18)"

    needs = {"(?=.*[0-9])": "[0-9]", "(?=.*[2-7])": "[2-7]", "(?=.*[a-z][A-Z]|.*[0-9])": "[a-z][A-Z]|[0-9]"}
    cases = []
    for i, (_, _, pattern, _) in enumerate(ENCODINGS):
        ahead = next((x for x in needs if pattern.startswith(x)), "")
        more = f" AND regexp_matches(token, '{needs[ahead]}')" if ahead else ""
        cases.append(f"WHEN regexp_full_match(token, '{pattern[len(ahead):]}'){more} THEN {i}")
    encoding = f"CASE {' '.join(cases)} ELSE -1 END"
    split = " UNION ALL ".join(
        f"SELECT doc_id, a, {i} AS alphabet, regexp_split_to_array(token, '{p}') AS gaps, regexp_extract_all(token, '{p}') AS hits FROM pieces WHERE enc < 0 AND regexp_matches(token, '{p}')"
        for i, p in enumerate(PARTS)
    )
    symbols = ", ".join(quoted(e[1]) for e in ENCODINGS)
    least = ", ".join(str(e[3]) for e in ENCODINGS)
    band = " + ".join(f"CASE WHEN n >= {b} THEN 1 ELSE 0 END" for b in BANDS[1:])
    names = "CASE kind " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS)) + " END || ':' || a || ':' || z"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = {i}) AS n_{k}" for i, k in enumerate(KINDS))
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM {source}),
{kind(0, ASSIGN, 2)},
{kind(1, ACCESS)},
{kind(2, HEX)},
{kind(3, RUN)},
base AS (
  SELECT doc_id, kind, a, a + length(token) AS z FROM m0 WHERE n >= 6
  UNION ALL SELECT doc_id, kind, a, a + length(token) FROM m1 UNION ALL SELECT doc_id, kind, a, a + length(token) FROM m2),
cuts AS (
  SELECT r.doc_id, r.a, r.token, b.a AS x, b.z AS y FROM m3 r JOIN base b ON b.doc_id = r.doc_id AND b.a < r.a + length(r.token) AND b.z > r.a
  UNION ALL SELECT doc_id, a, token, a + length(token), a + length(token) FROM m3),
between_cuts AS (
  SELECT doc_id, a, token, x, greatest(a, coalesce(max(y) OVER (PARTITION BY doc_id, a ORDER BY x, y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a)) AS start FROM cuts),
pieces AS (
  SELECT doc_id, a, token, {encoding} AS enc FROM (
    SELECT doc_id, start AS a, substring(token, start - a + 1, x - start) AS token FROM between_cuts WHERE x - start >= {LEAST_RUN})),
found AS (
  SELECT doc_id, a AS piece, alphabet, a + length(array_to_string(gaps[1:i], '')) + length(array_to_string(hits[1:i - 1], '')) AS a, hits[i] AS hit
  FROM (
    SELECT doc_id, a, alphabet, gaps, hits, unnest(range(1, len(hits) + 1)) AS i FROM (
      {split}))),
trimmed AS (
  SELECT doc_id, piece, alphabet, a + before AS a, regexp_replace(substring(hit, before + 1), '{WORDS_AFTER}', '') AS token
  FROM (SELECT *, length(regexp_extract(hit, '{WORDS_BEFORE}')) AS before FROM found)),
chosen AS (
  SELECT doc_id, piece, arg_max(alphabet, longest * 2 - alphabet) AS alphabet
  FROM (SELECT doc_id, piece, alphabet, max(length(token)) AS longest FROM trimmed WHERE length(token) >= {LEAST_RUN} GROUP BY ALL) GROUP BY doc_id, piece),
free AS (
  SELECT doc_id, a, a + length(token) AS z, token, {encoding} AS enc FROM (
    SELECT doc_id, a, token FROM pieces WHERE enc >= 0
    UNION ALL SELECT t.doc_id, t.a, t.token FROM trimmed t JOIN chosen USING (doc_id, piece, alphabet) WHERE length(t.token) >= {LEAST_RUN})),
usable AS (SELECT *, [{symbols}][enc + 1] AS alphabet FROM free WHERE enc >= 0 AND length(token) >= [{least}][enc + 1]),
chars AS (
  SELECT doc_id, a, z, enc, CAST(length(alphabet) AS DOUBLE) AS k, i, CAST(strpos(alphabet, token[i]) - 1 AS DOUBLE) AS v
  FROM (SELECT *, unnest(range(1, length(token) + 1)) AS i FROM usable)),
lagged AS (
  SELECT *, lag(v) OVER (PARTITION BY doc_id, a ORDER BY i) AS u, avg(v) OVER (PARTITION BY doc_id, a) AS mean,
         count(*) OVER (PARTITION BY doc_id, a, v) AS same FROM chars),
moments AS (
  SELECT doc_id, a, z, enc, k, CAST(count(*) AS DOUBLE) AS n, CAST(sum(same) AS DOUBLE) AS sq, CAST(count(*) FILTER (WHERE v >= k / 2) AS DOUBLE) AS high,
         CAST(count(*) FILTER (WHERE u IS NOT NULL AND (u >= k / 2) <> (v >= k / 2)) AS DOUBLE) AS changes,
         coalesce(sum((u - mean) * (v - mean)), 0.0) AS crossed, sum((v - mean) * (v - mean)) AS spread
  FROM lagged GROUP BY doc_id, a, z, enc, k),
stats AS (
  SELECT *, (pow((k / n * sq - n) / (k - 1), 1.0 / 3) - (1 - 2 / (9 * (k - 1)))) / sqrt(2 / (9 * (k - 1))) AS z1,
         1 + 2 * high * (n - high) / n AS mu, (2 * high * (n - high) / n) * (2 * high * (n - high) / n - 1) / (n - 1) AS var,
         CASE WHEN spread > 0 THEN abs(crossed / spread + 1 / n) * sqrt(n) END AS z3 FROM moments),
tests AS (
  SELECT *, CASE WHEN z1 >= 0 THEN {tail('z1')} ELSE 1 - {tail('-z1')} END AS p1,
         CASE WHEN high = 0 OR high = n THEN greatest(pow(0.5, n - 1), 1e-18) WHEN var > 0 THEN least(2 * {tail('abs(changes + 1 - mu) / sqrt(var)')}, 1.0) ELSE 1.0 END AS p2,
         CASE WHEN z3 IS NULL THEN 1e-18 ELSE least(2 * {tail('z3')}, 1.0) END AS p3 FROM stats),
joint AS (SELECT *, -(ln(p1) + ln(p2) + ln(p3)) AS h, enc * {len(BANDS)} + {band} AS stratum FROM tests),
binned AS (SELECT doc_id, a, z, stratum, least(floor(greatest(h - ln(1 + h + h * h / 2), 0.0) * {BINS_PER_E}), {MAX_BIN}) AS bin FROM joint),
counted AS (SELECT stratum, bin, count(*) AS n FROM binned GROUP BY stratum, bin),
ranked AS (SELECT *, sum(n) OVER (PARTITION BY stratum ORDER BY bin DESC) AS rank, sum(n) OVER (PARTITION BY stratum) AS m FROM counted),
cut AS (SELECT stratum, min(bin) AS bin FROM ranked WHERE exp(-bin / {BINS_PER_E}) <= {q} * rank / m GROUP BY stratum),
spans AS (
  SELECT doc_id, kind, a, z FROM base
  UNION ALL SELECT b.doc_id, 3, b.a, b.z FROM binned b LEFT JOIN cut c ON b.stratum = c.stratum WHERE c.bin IS NULL OR b.bin < c.bin),
per AS (
  SELECT doc_id, {counts}, string_agg({names}, ',' ORDER BY a, kind, z) FILTER (WHERE kind < 3) AS base, string_agg({names}, ',' ORDER BY a, kind, z) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in KINDS)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (doc_id)"""

"""Column functions (all JVM-side built-ins, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for equal results:
# 32-bit FNV-1a offset basis and prime, embedding token rule, bigram salt.
FNV_OFFSET = 2166136261
FNV_PRIME = 16777619
MASK32 = 4294967295
EMBED_TOKEN_PATTERN = "[a-z0-9]{2,}"   # split on [^a-z0-9]+, keep length >= 2
BIGRAM_PREFIX = "bg:"
BIGRAM_JOIN = "_"
UNIGRAM_WEIGHT = 1.0
BIGRAM_WEIGHT = 0.5

# Word rule for lexemes: maximal runs of Unicode letters / digits.
WORD_PATTERN = r"[\p{L}\p{N}]+"


# White space of JavaScript's trim: tab to carriage return, all Unicode separators, U+FEFF.
BLANK = r"[\t\n\x0B\f\r\p{Z}\uFEFF]"


def embed_tokens(text: Column) -> Column:
    """V1: lower-case, split on non ``[a-z0-9]``, keep tokens of length >= 2.

    The leftmost-longest match of ``[a-z0-9]{2,}`` yields exactly the maximal
    runs of length >= 2, so no split + filter pass is needed."""
    return F.regexp_extract_all(F.lower(text), F.lit(EMBED_TOKEN_PATTERN), 0)


def fnv1a32(s: Column) -> Column:
    """V2: 32-bit FNV-1a over the characters of ``s`` (inputs are ASCII).

    ``(h ^ c) * prime`` stays below 2^57, so the 64-bit product cannot
    overflow and the mask keeps the unsigned 32-bit value.  ``split('', '')``
    yields one empty string, so the empty input is special-cased."""
    h = F.aggregate(
        F.split(s, ""), F.lit(FNV_OFFSET).cast("long"),
        lambda h, c: ((h.bitwiseXOR(F.ascii(c).cast("long"))) * F.lit(FNV_PRIME))
        .bitwiseAND(F.lit(MASK32).cast("long")))
    return F.when(F.length(s) == 0, F.lit(FNV_OFFSET).cast("long")).otherwise(h)


def bigrams(tokens: Column) -> Column:
    """``bg:a_b`` for each adjacent pair of kept tokens."""
    n = F.size(tokens)
    rest = F.slice(tokens, 2, F.greatest(n - 1, F.lit(0)))
    return F.transform(rest, lambda t, i: F.concat(F.lit(BIGRAM_PREFIX), tokens[i],
                                                   F.lit(BIGRAM_JOIN), t))


def word_tokens(text: Column) -> Column:
    """T1 ``simple`` analysis: lower-case, maximal letter/digit runs."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD_PATTERN), 0)


def js_trim(s: Column) -> Column:
    """JavaScript ``String.trim``: strips all leading / trailing white space."""
    return F.regexp_replace(s, f"^{BLANK}+|{BLANK}+$", "")


def is_blank(q: Column) -> Column:
    """A query that is empty after trimming returns no hits."""
    return F.length(js_trim(F.coalesce(q, F.lit("")))) == 0


def limit_rule(k: Column, default: int = 20) -> Column:
    """A positive limit is used as is, anything else becomes ``default``."""
    return F.when(k.isNotNull() & (k > 0), k).otherwise(F.lit(default)).cast("int")


def snippet(body: Column, n: int = 220) -> Column:
    """First ``n`` characters, ``...`` appended when the body is longer."""
    return F.when(F.length(body) > n, F.concat(F.substring(body, 1, n), F.lit("..."))).otherwise(body)

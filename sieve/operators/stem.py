"""The ``english`` configuration -- stop words and English stemming.

Stop words are dropped but still use up a position; the body continues after
the title's last *kept* position.  Words are stemmed with the published
Snowball English ("Porter2") rules by an Arrow-batched helper that memoises
each batch's distinct words, so a corpus scan stays a narrow map (no
vocabulary shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import word_tokens
from .analyze import BODY_WEIGHT, RANK_WEIGHTS, TITLE_WEIGHT

# The English stop-word list of the `english` configuration (127 words).
STOP_WORDS = """i me my myself we our ours ourselves you your yours yourself yourselves he him his
himself she her hers herself it its itself they them their theirs themselves what which who whom this
that these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during before
after above below to from up down in out on off over under again further then once here there when
where why how all any both each few more most other some such no nor not only own same so than too
very s t can will just don should now""".split()

_V = set("aeiouy")
_DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
_LI_END = set("cdeghkmnrt")
# Snowball English exceptional forms.
_EXC1 = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
         "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
         "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
         "cosmos": "cosmos", "bias": "bias", "andes": "andes"}
_EXC2 = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
_STEP2 = [("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"),
          ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
          ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"),
          ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"),
          ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", "")]
_STEP3 = [("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"),
          ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", "")]
_STEP4 = ["ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous",
          "ive", "ize", "ion", "al", "er", "ic"]


def _is_v(w: str, i: int) -> bool:
    return w[i] in _V


def _regions(w: str) -> tuple[int, int]:
    def after(start: int) -> int:
        for i in range(start + 1, len(w)):
            if not _is_v(w, i) and _is_v(w, i - 1):
                return i + 1
        return len(w)
    for pre in ("gener", "commun", "arsen"):
        if w.startswith(pre):
            r1 = len(pre)
            break
    else:
        r1 = after(0)
    return r1, after(r1)


def _short_syllable_end(w: str) -> bool:
    n = len(w)
    if n >= 3:
        return (not _is_v(w, n - 3) and _is_v(w, n - 2) and not _is_v(w, n - 1)
                and w[n - 1] not in "wxY")
    return n == 2 and _is_v(w, 0) and not _is_v(w, 1)


def stem(word: str) -> str:
    """Snowball English stemmer (lower-case input)."""
    w = word
    if len(w) <= 2:
        return w
    if w in _EXC1:
        return _EXC1[w]
    if w.startswith("'"):
        w = w[1:]
    if w.startswith("y"):
        w = "Y" + w[1:]
    w = w[0] + "".join("Y" if c == "y" and w[i] in _V else c for i, c in enumerate(w[1:]))
    r1, r2 = _regions(w)
    # step 0
    for s in ("'s'", "'s", "'"):
        if w.endswith(s):
            w = w[: -len(s)]
            break
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ied") or w.endswith("ies"):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("us") or w.endswith("ss"):
        pass
    elif w.endswith("s"):
        if any(c in _V for c in w[:-2]):
            w = w[:-1]
    if w in _EXC2:
        return w
    # step 1b
    done = False
    for s in ("eedly", "eed"):
        if w.endswith(s):
            if len(w) - len(s) >= r1:
                w = w[: -len(s)] + "ee"
            done = True
            break
    if not done:
        for s in ("ingly", "edly", "ing", "ed"):
            if w.endswith(s):
                stem_ = w[: -len(s)]
                if any(c in _V for c in stem_):
                    w = stem_
                    if w.endswith(("at", "bl", "iz")):
                        w += "e"
                    elif w.endswith(_DOUBLES):
                        w = w[:-1]
                    elif _short_syllable_end(w) and r1 >= len(w):
                        w += "e"
                break
    # step 1c
    if len(w) > 2 and w[-1] in "yY" and not _is_v(w, len(w) - 2):
        w = w[:-1] + "i"
    # step 2
    for s, r in _STEP2:
        if w.endswith(s):
            if len(w) - len(s) >= r1:
                if s == "ogi":
                    if w[-4] == "l":
                        w = w[:-3] + r
                elif s == "li":
                    if len(w) >= 3 and w[-3] in _LI_END:
                        w = w[:-2]
                else:
                    w = w[: -len(s)] + r
            break
    # step 3
    for s, r in _STEP3:
        if w.endswith(s):
            if len(w) - len(s) >= r1:
                if s == "ative":
                    if len(w) - len(s) >= r2:
                        w = w[:-5]
                else:
                    w = w[: -len(s)] + r
            break
    # step 4
    for s in _STEP4:
        if w.endswith(s):
            if len(w) - len(s) >= r2:
                if s == "ion":
                    if len(w) >= 4 and w[-4] in "st":
                        w = w[:-3]
                else:
                    w = w[: -len(s)]
            break
    # step 5
    if w.endswith("e"):
        if len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_syllable_end(w[:-1])):
            w = w[:-1]
    elif w.endswith("l"):
        if len(w) - 1 >= r2 and len(w) >= 2 and w[-2] == "l":
            w = w[:-1]
    return w.replace("Y", "y")


def stem_batch(words):
    memo: dict[str, str] = {}
    out = []
    for x in words:
        if x is None:
            out.append(None)
            continue
        s = memo.get(x)
        if s is None:
            s = memo[x] = stem(x)
        out.append(s)
    return out


def stem_udf():
    from .._ship import ensure_package
    from ..functions.arrow import string_udf
    ensure_package()
    return string_udf(stem_batch)


def _stop_array():
    return F.array(*[F.lit(w) for w in STOP_WORDS])


def english_postings(corpus: DataFrame) -> DataFrame:
    """Postings under the ``english`` configuration (same columns as simple)."""
    stop = _stop_array()
    t = corpus.select("doc_id", word_tokens(F.col("title")).alias("_tt"),
                      word_tokens(F.col("body")).alias("_bt"))
    kept_title = F.filter(F.transform("_tt", lambda w, i: F.struct(w.alias("w"), (i + 1).alias("p"))),
                          lambda x: ~F.array_contains(stop, x["w"]))
    t = t.select("doc_id", "_tt", "_bt",
                 F.coalesce(F.array_max(F.transform(kept_title, lambda x: x["p"])), F.lit(0)).alias("_shift"))
    e = t.select("doc_id", F.size("_tt").alias("_nt"), "_shift",
                 F.posexplode(F.concat("_tt", "_bt")).alias("_i", "word"))
    is_title = F.col("_i") < F.col("_nt")
    pos = F.when(is_title, F.col("_i") + 1).otherwise(F.col("_i") - F.col("_nt") + 1 + F.col("_shift"))
    e = e.where(~F.array_contains(stop, F.col("word")))
    return e.select("doc_id", stem_udf()(F.col("word")).alias("term"), pos.cast("int").alias("pos"),
                    F.when(is_title, F.lit(TITLE_WEIGHT)).otherwise(F.lit(BODY_WEIGHT)).alias("weight"),
                    F.when(is_title, F.lit(RANK_WEIGHTS[TITLE_WEIGHT]))
                    .otherwise(F.lit(RANK_WEIGHTS[BODY_WEIGHT])).alias("w"))


def analyse_query_rows(rows: DataFrame) -> DataFrame:
    """Query term rows under ``english``: stop words dropped (offsets, i.e.
    phrase gaps, kept), words stemmed, ``n_words`` = kept words of the item."""
    from pyspark.sql import Window
    kept = rows.where(~F.array_contains(_stop_array(), F.col("term")))
    w = Window.partitionBy("query_id", "clause_id", "item_id")
    return kept.select("query_id", "clause_id", "item_id", "negated", "offset",
                       stem_udf()(F.col("term")).alias("term"),
                       F.count("*").over(w).cast("int").alias("n_words"))

"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

Steps (``score_documents``):

1. Words and word beginnings that mark the positive label are gathered from a
   bounded sample of labelled documents (part 0 of the labels), as document
   counts in Spark with near copies counted once; the strongest are kept
   (``LEARNED_WORDS`` at most) beside a fixed list of insults.  Beginnings
   serve languages in which the list's words are inflected or unknown.
2. One Arrow pass over all whole texts makes the dense features: lexicon
   densities, second-person words near a lexicon word, capitals, punctuation,
   obfuscated and stretched words.  No shuffle; memory is one batch plus a
   bounded word cache.
3. ``GBTClassifier`` learns on part 1 of the labels, ``IsotonicRegression``
   maps its probability to a calibrated one on part 2.  The parts are disjoint
   and, with the rows kept out, split by crc32 of the document id.
4. The models score the feature table on the JVM side.

Edge cases: a null text counts as empty; an empty text has all features 0 and
gets the score of such a document; a null id goes to its own part like any
other (crc32 of the empty string); repeated rows each get a row; labels given
twice for an id count once, as 1 if any row says 1; null labels are ignored; if
the labels lack one of the classes every document gets the smoothed share of
label 1; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import TEXT_BATCH, in_worker, python_ready, row_key, saved, within

#: Insults looked for by default; a parameter of ``score_documents``.
LEXICON = (
    "arsehole", "asshole", "bastard", "bitch", "bully", "clown", "coward", "cretin", 
    "degenerate", "despicable", "disgusting", "dumb", "dumbass", "filth", "freak", "garbage", 
    "hateful", "idiot", "idiotic", "ignorant", "imbecile", "incompetent", "jerk", "liar",
    "loser", "lunatic", "maggot", "moron", "moronic", "nasty", "parasite", "pathetic", "psycho", 
    "repulsive", "retard", "scum", "shit", "slut", "stupid", "swine", "trash", "ugly", "useless",
    "vermin", "whore", "worthless", "dummkopf", "dumm", "arschloch", "abschaum", "hässlich", "wertlos",
    "imbécile", "connard", "débile", "ordure", "stupide", "idiote", "estúpido", "basura", "imbécil", "inútil",
    "idiota", "asqueroso",
)
#: Words that address the reader.
SECOND_PERSON = frozenset((
    "you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "tu", "toi", "te",
    "ton", "ta", "tes", "vous", "votre", "tú", "usted", "ustedes", "vos"))
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})

#: Bound on labelled documents used for each of the three parts.
MAX_PART = 40_000
#: Least hashes of long words that near copies share.
LEAST = 6
#: Bound on learned words.
LEARNED_WORDS = 2_000
#: Lengths of the word beginnings that are learned.
STEMS = (4, 5, 6, 7)
#: Share among positives over share among negatives: to be learned, and to be strong.
RATIO, STRONG = 8, 40
#: Words of a document are looked at this far from a lexicon word.
NEAR = 3
THRESHOLD = 0.3

FEATURES = ("log_words", "lexicon", "learned", "strong", "strong_count", "obfuscated", "hits", "near_second", "second", "mixed", "shouted",
            "stretched", "upper", "punct", "marks", "digits", "symbols")
_LEX, _LEARNED, _OBF, _SECOND, _MIXED, _SHOUT, _STRETCH, _STRONG = (1 << i for i in range(8))
_BITS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(float)
#: By byte: capitals, punctuation, marks of emphasis, digits, symbols.
_KINDS = np.zeros((256, 5))
_KINDS[65:91, 0] = _KINDS[[33, 63], 2] = _KINDS[48:58, 3] = _KINDS[[*range(35, 39), 42, 64], 4] = 1
_KINDS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)], 1] = 1
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_MARKS = ".,;:?\"'()"
_PLAIN = {i: "".join(c for c in unicodedata.normalize("NFKD", chr(i)) if not unicodedata.combining(c)) for i in range(128, 0x180)}
_RUN = re.compile(r"(.)\1{2,}")
_CACHE = 400_000


class WordCodes(dict):
    """Bit codes by word, filled on first sight; the cache is bounded."""

    def __init__(self, lexicon, learned):
        """``learned``: ``(word or beginning, whether strong)``; a beginning ends in ``*``."""
        super().__init__()
        self.lexicon, self.learned = frozenset(lexicon), dict(learned)
        self.masked = {w[:i] + w[i + 1:] for w in self.lexicon if len(w) > 3 for i in range(1, len(w) - 1)}
        self.known = self.lexicon | SECOND_PERSON | self.learned.keys()
        self.begins = {w[:min(STEMS)] for w in self.learned if w.endswith("*")}

    def __missing__(self, word: str) -> int:
        low = word.lower()
        core = low.strip(_MARKS)
        # Most words: letters that nothing is known of, with or without accents, in lower case and without a run.
        if core.isalpha() and (low == word or len(core) < 2 or word.upper() != word) and core not in self.known \
                and core[:min(STEMS)] not in self.begins and not _RUN.search(core) \
                and (core.isascii() or max(core) < "\u0180" and core.translate(_PLAIN) not in self.known):
            code = 0
        else:
            code = self.code(word)
        if len(self) >= _CACHE:
            self.clear()
        self[word] = code
        return code

    def code(self, word: str) -> int:
        core = _EDGE.sub("", word.lower())
        found = [self.learned.get(core)] + [self.learned.get(f"{core[:k]}*") for k in STEMS if len(core) >= k]
        code = _LEX * (core in self.lexicon) + _SECOND * (core in SECOND_PERSON) + _STRONG * (True in found)
        code |= _LEARNED * (True in found or False in found)
        letters = len(core) if core.isalpha() else sum(map(str.isalpha, core))
        if letters and letters < len(core):
            code |= _MIXED
        body = word.lower().strip(_MARKS)
        plain = []
        if not body.isalpha():  # digits and symbols in place of letters
            plain = [core.translate(LEET), body.translate(LEET)]
            plain += ["".join(c for c in x if c.isalpha()) for x in plain]
        if _RUN.search(body):
            plain += [_RUN.sub(r"\1", x) for x in (core, *plain)]
        if not core.isascii():
            plain.append("".join(c for c in unicodedata.normalize("NFKD", core) if not unicodedata.combining(c)))
        if not code & (_LEX | _LEARNED) and len(core) > 2 and any(
                x in self.lexicon or self.learned.get(x) or "*" in body and x in self.masked for x in plain):
            code |= _OBF
        if letters > 1 and word.upper() == word and word.lower() != word:
            code |= _SHOUT
        if _RUN.search(core):
            code |= _STRETCH
        return code


def features_of(text: str | None, codes: WordCodes) -> list[float]:
    """The dense features of one text, in the order of ``FEATURES``."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    c = np.frombuffer(bytes(map(codes.__getitem__, words)), np.uint8)
    n_lex, n_learned, n_obf, n_second, n_mixed, n_shout, n_stretch, n_strong = (np.bincount(c, minlength=256) @ _BITS).tolist()
    hits = near = 0
    if n_lex or n_strong or n_obf:
        hit = np.flatnonzero(c & (_LEX | _STRONG | _OBF))
        hits = len(hit)
        if n_second:
            second = np.flatnonzero(c & _SECOND)
            near = int((np.searchsorted(second, hit + NEAR, "right") > np.searchsorted(second, hit - NEAR, "left")).sum())
    b = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    upper, punct, marks, digits, symbols = (np.bincount(b, minlength=256) @ _KINDS / float(len(b))).tolist()
    return [float(np.log1p(n)), n_lex / n, n_learned / n, n_strong / n,
            float(np.log1p(n_strong)), n_obf / n, float(np.log1p(hits)),
            near / n, n_second / n, n_mixed / n, n_shout / n, n_stretch / n,
            upper, punct, marks, digits, symbols]


def dense_features(docs: DataFrame, lexicon, learned, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, key, features array<double>)``, one row per row of ``docs``; ``key`` is its ``row_key``."""
    python_ready(docs.sparkSession)
    lexicon, learned = tuple(lexicon), tuple(learned)

    def run(batches):
        codes = WordCodes(lexicon, learned)
        for b in batches:
            yield pa.record_batch([b.column(0), b.column(2), pa.array([features_of(t, codes) for t in b.column(1).to_pylist()],
                                                                      pa.list_(pa.float64()))], names=["doc_id", "key", "features"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row_key(F.col(id_col), F.col(text_col)).alias("key")) \
        .mapInArrow(in_worker("toxicity", run), "doc_id long, key long, features array<double>")


def part_of(doc_id):
    """crc32 of the id as text, modulo 4; 2 is kept out of learning."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def _sample(rows: DataFrame, n: int, bound: int) -> DataFrame:
    """All of ``rows``, or about ``bound`` of its ``n`` rows picked by a hash of the id."""
    if n <= bound:
        return rows
    return rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * bound / n))


def learned_words(rows: DataFrame, limit: int = LEARNED_WORDS) -> list[tuple[str, bool]]:
    """Words and beginnings over-represented in rows of label 1: ``rows`` is ``(text, label)``.

    At least 3 and 1 in 200 of the positive documents hold such a unit, with
    ``RATIO`` times the share among the negative ones; the ``limit`` with the
    most positive documents are kept, with whether they reach ``STRONG``.
    Documents of one label with the same ``LEAST`` least hashes of long words (with
    fewer long words: with the same words) are near copies and count once."""
    words = F.array_distinct(F.transform(F.split(F.lower("text"), r"\s+"),
                                         lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")))
    long_words = F.filter("words", lambda w: F.length(w) >= 8)
    rows = rows.select("label", words.alias("words")) \
        .withColumn("mark", F.when(F.size(long_words) >= LEAST, F.xxhash64(F.slice(F.array_sort(F.transform(long_words, lambda w: F.xxhash64(w))), 1, LEAST)))
                    .otherwise(F.xxhash64(F.array_sort("words")))) \
        .groupBy("label", "mark").agg(F.min("words").alias("words"))
    rows = saved(rows, "tox-words")
    sizes = rows.agg(F.sum("label").alias("p"), F.count("*").alias("n")).first()
    p, n = int(sizes.p or 0), int(sizes.n)
    if not p or p == n:
        return []
    stems = [F.transform(F.filter("words", lambda w, k=k: F.length(w) >= k), lambda w, k=k: F.concat(F.substring(w, 1, k), F.lit("*")))
             for k in STEMS]
    units = F.array_distinct(F.concat(F.filter("words", lambda w: F.length(w) > 2), *stems))
    share = (F.col("pos") / p) / ((F.col("all") - F.col("pos") + 0.5) / (n - p + 1))
    top = rows.select("label", F.explode(units).alias("w")).groupBy("w") \
        .agg(F.sum("label").alias("pos"), F.count("*").alias("all")) \
        .filter((F.col("pos") >= max(3, p / 200)) & (share >= RATIO)) \
        .orderBy(F.desc("pos"), "w").limit(limit)
    return [(r.w, r.strong) for r in top.select("w", (share >= STRONG).alias("strong")).collect()]


def score_documents(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
                    text_col: str = "text", lexicon=LEXICON, threshold: float = THRESHOLD, held_out_part: int = 2,
                    max_part: int = MAX_PART, trees: int = 20, depth: int = 3, seed: int = 7, keyed: bool = False) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``, with ``keyed`` also the ``row_key`` as ``key``."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).cast("long").alias("doc_id")) \
        .agg((F.max(F.col(label_col).cast("int")) > 0).cast("double").alias("label")) \
        .withColumn("part", part_of(F.col("doc_id"))).filter(F.col("part") != held_out_part)
    known = saved(known, "tox-labels")
    by_part = {r.part: (r.n, r.p) for r in known.groupBy("part").agg(
        F.count("*").alias("n"), F.sum("label").alias("p")).collect()}
    words_part, trees_part, calm_part = (i for i in range(4) if i != held_out_part)

    some = _sample(known.filter(F.col("part") == words_part), by_part.get(words_part, (0, 0))[0], max_part)
    learned = learned_words(docs.join(within(some), "doc_id").select("text", "label"))
    feats = saved(dense_features(docs, lexicon, learned), "tox-features", TEXT_BATCH)

    train = saved(feats.join(known.filter(F.col("part") != words_part), "doc_id").transform(
        lambda d: _sample(d, sum(by_part.get(k, (0, 0))[0] for k in (trees_part, calm_part)), 2 * max_part))
        .select("part", "label", "features"), "tox-train").coalesce(8) \
        .withColumn("features", array_to_vector("features"))
    n_by = {(r.part, r.label): r.n for r in train.groupBy("part", "label").agg(F.count("*").alias("n")).collect()}
    at = lambda part, label: n_by.get((part, float(label)), 0)
    out = feats.select("doc_id", "key", (part_of(F.col("doc_id")) == held_out_part).alias("held_out"), "features")
    if not at(trees_part, 0) or not at(trees_part, 1):
        n, p = sum(x[0] for x in by_part.values()), sum(x[1] or 0 for x in by_part.values())
        score = F.lit((p + 0.5) / (n + 1.0))
        out = out.withColumn("score", score)
    else:
        model = GBTClassifier(labelCol="label", featuresCol="features", maxIter=trees, maxDepth=depth, maxBins=64,
                              seed=seed).fit(train.filter(F.col("part") == trees_part))
        p1 = vector_to_array("probability")[1]
        out = model.transform(out.withColumn("features", array_to_vector("features"))).withColumn("p", p1)
        if at(calm_part, 0) and at(calm_part, 1):
            calm = model.transform(train.filter(F.col("part") == calm_part)).withColumn("p", p1)
            iso = IsotonicRegression(labelCol="label", featuresCol="p", predictionCol="score").fit(
                calm.select("label", "p"))
            out = iso.transform(out.select("doc_id", "key", "held_out", "p"))
        else:
            out = out.withColumn("score", F.col("p"))
    score = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
    return out.select("doc_id", *["key"] * keyed, "held_out", score.alias("score"),
                      (score >= threshold).cast("int").alias("predicted"))

"""Secret scans: a random forest removes false positives from candidate strings.

Candidates are runs of 16 or more characters of the usual key alphabets that
hold a digit or have a known key format, and besides every value assigned to a
name like ``password``, whatever its length and alphabet.  Each is described by its length, transitions between kinds of
characters, share of distinct characters, dictionary coverage, signs of a path
or URL around it, and the neighbouring words.  A ``RandomForestClassifier``
learned from labelled findings scores all of them; a known key format scores 1.

Labelled findings may be given; by default they come from two rules over a
bounded sample of documents: assigned to a name like ``token`` or ``api_key``
is a secret, a value found only by its name if it is quoted or holds a digit;
neither assigned, nor quoted, nor beside such a name, nor of a known format is none.  All
other findings are left to the forest.

Everything is DataFrame functions and ``pyspark.ml``.  Texts are split once by
the candidate pattern, so the work is linear in the text; there is no shuffle
of texts.  Findings carry a SHA-256 of the candidate, not the candidate.

Edge cases: null and empty texts have no findings; repeated rows and repeated
candidates each get their rows; a null id is kept; if the labels lack a class
every finding gets the smoothed share of secrets among them; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import saved

CANDIDATE = r"[A-Za-z0-9+/_\-]{16,}={0,2}"
CONTEXT = 48
#: Bound on labelled findings used for training; each class has half of it at least.
MAX_LABELLED = 50_000
#: Words that names of keys hold, and words beside harmless identifiers.
KEY_WORDS = "token|secret|passw(or)?d|passwd|api[_-]?key|access[_-]?key|auth|bearer|credential|private"
HARMLESS = "sha1|sha256|md5|commit|checksum|digest|uuid|guid|etag|isbn|doi|revision"
#: Formats of keys that need no context.
FORMATS = (r"^((AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_\-]{20,}|AIza[A-Za-z0-9_\-]{35}"
           r"|[sr]k_(live|test)_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9\-]{10,})$")
#: A name of a key, an assignment and a value (quoted, or up to a blank).
ASSIGNED = (rf"(?i)((?:{KEY_WORDS.replace('(or)', '(?:or)')})[\"'`]?\s{{0,2}}(?::=|[=:])\s{{0,2}})"
            r"(\"[^\"\r\n]+\"|'[^'\r\n]+'|`[^`\r\n]+`|[^\s\"'`]*[^\s\"'`,;)\]}.])")
#: Common words and parts of words, for dictionary coverage.
DICTIONARY = (
    "about", "after", "and", "are", "back", "been", "code", "com", "content", "could", "data", "date", "default", "document",
    "example", "file", "first", "for", "from", "get", "have", "head", "html", "http", "image", "index", "info", "item", "label",
    "license", "like", "line", "link", "list", "mail", "main", "make", "name", "new", "number", "one", "other", "page", "part",
    "path", "people", "public", "release", "result", "section", "set", "some", "source", "string", "test", "text", "that", "the",
    "their", "there", "this", "time", "title", "tion", "type", "user", "value", "version", "was", "web", "with", "word", "work", "you")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, place, value, left, right`` of every candidate.

    ``place`` counts the document's runs from 0; values that only their names
    show have the places -1, -2, ... in order of the assignments."""
    text = F.coalesce(F.col("text"), F.lit(""))
    wanted = lambda x: x.rlike("[0-9]") | x.rlike(FORMATS)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).select(
        "doc_id", F.regexp_extract_all(text, F.lit(CANDIDATE), 0).alias("runs"), F.split(text, CANDIDATE, -1).alias("rest"),
        F.regexp_extract_all(text, F.lit(ASSIGNED), 0).alias("given"), F.split(text, ASSIGNED, -1).alias("around")) \
        .filter(F.exists("runs", wanted) | (F.size("given") > 0))
    found = F.transform("runs", lambda x, i: F.struct(
        i.alias("place"), x.alias("value"), F.right(F.col("rest")[i], F.lit(CONTEXT)).alias("left"),
        F.left(F.col("rest")[i + 1], F.lit(CONTEXT)).alias("right")))

    def assigned(x: Column, i: Column) -> Column:
        before, value = F.regexp_extract(x, ASSIGNED, 1), F.regexp_extract(x, ASSIGNED, 2)
        quote = F.regexp_extract(value, r"^([\"'`]?)", 1)
        return F.struct((-1 - i).alias("place"), F.regexp_extract(value, r"(?s)^([\"'`]?)(.*)\1$", 2).alias("value"),
                        F.right(F.concat(F.col("around")[i], before, quote), F.lit(CONTEXT)).alias("left"),
                        F.left(F.concat(quote, F.col("around")[i + 1]), F.lit(CONTEXT)).alias("right"))

    run = lambda x: x["value"].rlike(f"^{CANDIDATE}$") & wanted(x["value"])  # noqa: E731  found as a run already
    return rows.select("doc_id", F.explode(F.concat(
        F.filter(found, lambda x: wanted(x["value"])), F.filter(F.transform("given", assigned), lambda x: ~run(x)))).alias("x")) \
        .select("doc_id", "x.*")


def _flags() -> dict[str, Column]:
    left, right = F.lower(F.col("left")), F.col("right")
    return {"named": left.rlike(rf"({KEY_WORDS})[^a-z0-9]{{0,8}}$"), "harmless": left.rlike(rf"\b({HARMLESS})[^a-z0-9]{{0,8}}$"),
            "assigned": left.rlike(r"[=:]\s*[\"']?$"), "quoted": left.rlike(r"[\"'`]$") & right.rlike(r"^[\"'`]"),
            "url": left.rlike(r"(https?://|www\.)\S*$") | (F.col("value").contains("//"))}


def features(found: DataFrame) -> DataFrame:
    """Add the flags and ``features array<double>``."""
    v, size = F.col("value"), F.length("value").cast("double")
    count = lambda pattern: F.regexp_count(v, F.lit(pattern)).cast("double")
    covered = size - F.length(F.regexp_replace(F.lower(v), "|".join(DICTIONARY), ""))
    flags = _flags()
    found = found.withColumns(flags)
    xs = [F.log(size), count("[a-z](?=[A-Z0-9])|[A-Z](?=[a-z0-9])|[0-9](?=[A-Za-z])") / size, count("[0-9]") / size, count("[A-Z]") / size,
          count("[a-z]") / size, count("[+/_=-]") / size, F.size(F.array_distinct(F.split(v, ""))) / size, covered / size,
          v.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"), v.rlike("^[0-9/_-]+$").cast("double"),
          count("/") / size, F.col("right").rlike(r"^\.[a-z]{2,4}\b").cast("double"),
          F.length(F.regexp_extract("left", r"(\S*)$", 1)).cast("double"),
          F.regexp_count(F.lower(F.concat_ws(" ", "left", "right")), F.lit(r"\b(the|of|and|to|in|de|la|der|die)\b")).cast("double")]
    return found.withColumn("features", F.array(*xs, *[F.coalesce(F.col(x), F.lit(False)).cast("double") for x in flags]))


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5,
         trees: int = 20, depth: int = 5, seed: int = 7, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, place, length, sha256, score, is_secret`` for every candidate.

    ``labelled`` is ``(doc_id, place, label)`` of findings judged by hand."""
    found = saved(features(candidates(docs, id_col, text_col)), "secret-found")
    if labelled is None:
        sure = (F.col("place") >= 0) | F.col("quoted") | F.col("value").rlike("[0-9]")
        label = F.when(F.col("value").rlike(FORMATS) | (F.col("named") & F.col("assigned") & sure), 1.0) \
            .when(~F.col("named") & ~F.col("assigned") & ~F.col("quoted"), 0.0)
        known = found.withColumn("label", label)
    else:
        known = found.join(labelled.select("doc_id", "place", F.col("label").cast("double").alias("label")), ["doc_id", "place"])
    known = known.filter("label IS NOT NULL")
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    pos, neg = sizes.get(1.0, 0), sizes.get(0.0, 0)
    if pos + neg > max_labelled:  # a class within its half stays whole and leaves the rest to the other
        known = _sampled(known, {1.0: (pos, max(max_labelled - neg, max_labelled // 2)), 0.0: (neg, max(max_labelled - pos, max_labelled // 2))})
    known = saved(known.select("label", "features"), "secret-train")
    if known.select("label").distinct().count() < 2:
        return _out(found.withColumn("score", F.lit((pos + 0.5) / (pos + neg + 1.0))), threshold)
    train = known.coalesce(8)
    model = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed).fit(
        train.withColumn("features", array_to_vector("features")))
    scored = model.transform(found.withColumn("features", array_to_vector("features")))
    return _out(scored.withColumn("score", vector_to_array("probability")[1]), threshold)


def _sampled(known: DataFrame, bounds: dict) -> DataFrame:
    """Of each label ``(n, bound)`` in ``bounds`` all of its ``n`` rows, or about ``bound`` of them picked by a hash of the finding."""
    share = F.lit(0.0)
    for label, (n, bound) in bounds.items():
        share = F.when(F.col("label") == label, F.lit(1.0 if n <= bound else bound / n)).otherwise(share)
    return known.filter(F.pmod(F.xxhash64("doc_id", "place", "value"), F.lit(1_000_000)) < F.lit(1e6) * share)


def _out(rows: DataFrame, threshold: float) -> DataFrame:
    rows = rows.withColumn("score", F.when(F.col("value").rlike(FORMATS), F.lit(1.0)).otherwise(F.col("score")))
    return rows.select("doc_id", "place", F.length("value").alias("length"), F.sha2("value", 256).alias("sha256"), "score",
                       (F.col("score") >= threshold).cast("int").alias("is_secret"))

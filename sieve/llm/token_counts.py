"""Token counts by section: offset-mapped attribution.

Each document is encoded once, whole.  A byte-level token stands for a fixed
number of bytes, so running sums of the tokens' byte lengths give every token's
span in the UTF-8 text.  Sections are spans of the same bytes; tokens and
sections, both in order, are joined as intervals with two binary searches.

A token that crosses a boundary goes, whole, to the section that holds most of
its bytes, and in a tie to the earlier one (``rule="most"``), or to the section
of its first byte (``rule="first"``).  So the sections' counts always sum to
the document's.

Sections are the lines of a text (each with its line end), cut again before
each space that follows a full stop, question or exclamation mark, when
``sentences`` is set.  A section may also be named by the caller as a pattern.

Edge cases: a null or empty text has one empty section with 0 tokens; a text
without line ends is one section; repeated rows each get their rows; a null id
is kept as null; other columns are ignored; memory is one batch of texts.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import python_ready
from .encoding import default_tokenizer, encoder

LINES = r"\n"
#: Ends of lines, and of sentences before a space.
SENTENCES = r"\n|[.!?](?= )"
_LENGTHS: dict[str, np.ndarray] = {}


def byte_lengths(path: str) -> np.ndarray:
    """Bytes that each id stands for; the alphabet of a byte-level vocabulary has one character a byte."""
    if path not in _LENGTHS:
        enc = encoder(path)
        vocab = enc.tokenizer.get_vocab(with_added_tokens=True)
        out = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            out[i] = len(token.encode()) if token in enc.added else len(token)
        _LENGTHS[path] = out
    return _LENGTHS[path]


def attributed(ends: np.ndarray, cuts: np.ndarray, rule: str = "most") -> tuple[np.ndarray, int]:
    """Section of each token, and how many tokens cross a boundary.

    ``ends`` are the tokens' end offsets, ``cuts`` the sections'; both rise and
    end at the same byte."""
    starts = np.concatenate(([0], ends[:-1]))
    first = np.searchsorted(cuts, starts, "right")
    last = np.searchsorted(cuts, ends, "left")
    cross = np.flatnonzero(last > first)
    section = first.copy()
    if rule == "most":
        for t in cross.tolist():
            edge = np.concatenate(([starts[t]], cuts[first[t]:last[t]], [ends[t]]))
            section[t] = first[t] + int(np.argmax(np.diff(edge)))  # the first of equals
    return section, len(cross)


def token_counts(docs: DataFrame, sections: str = SENTENCES, rule: str = "most", tokenizer: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, section, start, end, n_tokens, n_crossing``: a row per section of each document.

    ``start`` and ``end`` are byte offsets; ``n_crossing`` counts the tokens
    given to the section that also hold bytes of another."""
    if rule not in ("most", "first"):
        raise ValueError("rule is 'most' or 'first'")
    python_ready(docs.sparkSession)
    tokenizer = tokenizer or default_tokenizer()
    names = ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"]

    def run(batches):
        enc, lengths, cut = encoder(tokenizer), byte_lengths(tokenizer), re.compile(sections.encode())
        for b in batches:
            cols, rows = [[] for _ in names], 0

            def batch():
                return pa.record_batch([pa.array(np.concatenate(c[:1] and c)) if j else pa.array(
                    [d for ds in c for d in ds], pa.int64()) for j, c in enumerate(cols)], names=names)

            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = (text or "").encode("utf-8", "surrogatepass")
                cuts = [m.end() for m in cut.finditer(raw)]
                if not cuts or cuts[-1] != len(raw):
                    cuts.append(len(raw))
                cuts = np.array(cuts, np.int64)
                ends = np.cumsum(lengths[np.frombuffer(enc.ids(text), "<u4")])
                n = np.zeros(len(cuts), np.int64)
                crossing = n.copy()
                if len(ends):
                    if ends[-1] != len(raw):
                        raise ValueError("the tokens' lengths don't add up to the text")
                    section, crossed = attributed(ends, cuts, rule)
                    n = np.bincount(section, minlength=len(cuts))
                    if crossed:
                        starts = np.concatenate(([0], ends[:-1]))
                        over = np.searchsorted(cuts, ends, "left") > np.searchsorted(cuts, starts, "right")
                        crossing = np.bincount(section[over], minlength=len(cuts))
                for c, v in zip(cols, ([doc] * len(cuts), np.arange(len(cuts)), np.concatenate(([0], cuts[:-1])), cuts, n, crossing)):
                    c.append(v)
                rows += len(cuts)
                if rows >= 100_000:
                    yield batch()
                    cols, rows = [[] for _ in names], 0
            if rows:
                yield batch()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, section long, start long, end long, n_tokens long, n_crossing long")

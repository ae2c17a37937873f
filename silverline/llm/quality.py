"""Quality rules as a short-circuit cascade (operator 2).

Base metrics of each text are computed for all rows with numpy over Arrow
buffers.  The rules that follow run as a cascade: each sees only the rows that
every earlier rule let through.  A text is kept if no rule rejects it, so the
order changes the cost and never the verdict.  The order comes from a sample
of ``sample_rows`` rows (a bound on the profile alone): every rule runs on
all of the sample, its seconds a row and its share of rejections are measured,
and the rules are sorted by rejections per second.

Words are runs of ``[^\\x20\\x09-\\x0D]``; lines end at ``\\n``.

Defined cases: a null or empty text has no words, so it fails the base check
and is not kept.  Repeated rows are judged one by one.  Input columns named as
the results are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.llm import common as C

SAMPLE_ROWS = 2000
WINDOW = 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_ASCII_LETTER = _LETTER.copy()
_ASCII_LETTER[128:] = False


class Texts:
    """One slice of texts with its base metrics; ``subset`` keeps some rows."""

    def __init__(self, texts: pa.Array):
        self.texts = texts
        self.data, self.off = C.text_buffers(texts)
        self._words = None
        self.base: dict[str, np.ndarray] = {}

    def subset(self, rows: np.ndarray) -> Texts:
        out = Texts(self.texts.take(pa.array(rows)))
        out.base = {k: v[rows] for k, v in self.base.items()}
        return out

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text carry a flag."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.off[1:]] - total[self.off[:-1]]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, start, end) of each word."""
        if self._words is None:
            start, end = C.word_spans(self.data, self.off)
            self._words = np.searchsorted(self.off, start, side="right") - 1, start, end
        return self._words

    def measure(self) -> Texts:
        n = len(self.off) - 1
        row, start, end = self.words()
        ink = ~C.IS_SPACE[self.data]
        line_row, a, b = C.line_spans(self.data, self.off)
        inked = np.zeros(len(ink) + 1, np.int64)
        np.cumsum(ink, out=inked[1:])
        full = inked[b] > inked[a]
        line_row, a, b = line_row[full], a[full], b[full]
        again = _repeats(line_row, C.span_hash(self.data, a, b))
        self.base = {
            "n_words": np.bincount(row, minlength=n), "word_chars": self.per_row(ink & ((self.data & 0xC0) != 0x80)),
            "n_symbols": self.per_row(_SYMBOL[self.data]), "n_dup_lines": np.bincount(line_row[again], minlength=n),
            "n_repeat_words": _repeat_words(row, C.span_hash(self.data, start, end), n), "n_lines": np.bincount(line_row, minlength=n)}
        return self

    def base_failed(self) -> np.ndarray:
        words, repeated = self.base["n_words"], self.base["n_repeat_words"]
        return (words < 10) | (100 * repeated > 20 * words)


def _repeats(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Positions whose (row, hash) was seen at an earlier position."""
    key = C.mix(h ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key, kind="stable")
    return order[1:][key[order][1:] == key[order][:-1]]


def _repeat_words(row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Words that lie in windows of five that a text holds twice or more."""
    windows = C.window_hash(h, WINDOW)
    own = np.flatnonzero(row[WINDOW - 1:] == row[:len(row) - WINDOW + 1]) if len(row) >= WINDOW else np.zeros(0, np.int64)
    key = C.mix(windows[own] ^ (row[own].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key)
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(own), bool)
    twice[1:] |= same
    twice[:-1] |= same
    at = own[order[twice]]
    cover = np.zeros(len(row) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.subtract.at(cover, at + WINDOW, 1)
    return np.bincount(row[np.cumsum(cover[:-1]) > 0], minlength=n)


def _symbol_ratio(t: Texts) -> np.ndarray:
    return 10 * t.base["n_symbols"] > t.base["n_words"]


def _word_length(t: Texts) -> np.ndarray:
    chars, words = t.base["word_chars"], t.base["n_words"]
    return (chars < 3 * words) | (chars > 12 * words)


def _duplicate_lines(t: Texts) -> np.ndarray:
    """Over 30 % of the lines repeat; one or two repeats say nothing."""
    return (t.base["n_dup_lines"] >= 3) & (10 * t.base["n_dup_lines"] > 3 * t.base["n_lines"])


def _upper_case(t: Texts) -> np.ndarray:
    return 2 * t.per_row(_UPPER[t.data]) > t.per_row(_ASCII_LETTER[t.data])


def _exclamations(t: Texts) -> np.ndarray:
    return 5 * t.per_row(t.data == 0x21) > t.base["n_words"]


def _words_without_letters(t: Texts) -> np.ndarray:
    row, start, end = t.words()
    letters = np.zeros(len(t.data) + 1, np.int64)
    np.cumsum(_LETTER[t.data], out=letters[1:])
    return 2 * np.bincount(row[letters[end] == letters[start]], minlength=len(t.off) - 1) > t.base["n_words"]


def _one_word_share(t: Texts) -> np.ndarray:
    """The most frequent word makes up over a fifth of 50 words or more."""
    row, start, end = t.words()
    key = C.mix(C.span_hash(t.data, start, end) ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key)
    first = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])) if len(key) else np.zeros(0, np.int64)
    most = np.zeros(len(t.off) - 1, np.int64)
    np.maximum.at(most, row[order[first]], np.diff(first, append=len(key)))
    return (t.base["n_words"] >= 50) & (5 * most > t.base["n_words"])


def _stutter(t: Texts) -> np.ndarray:
    """Over a fifth of the words equal the word before."""
    row, start, end = t.words()
    h = C.span_hash(t.data, start, end)
    same = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    return 5 * np.bincount(row[1:][same], minlength=len(t.off) - 1) > t.base["n_words"]


#: Each rule says which texts of a measured slice it rejects.
RULES: dict[str, Callable[[Texts], np.ndarray]] = {
    "symbol_ratio": _symbol_ratio,
    "word_length": _word_length,
    "duplicate_lines": _duplicate_lines,
    "upper_case": _upper_case,
    "exclamations": _exclamations,
    "words_without_letters": _words_without_letters,
    "one_word_share": _one_word_share,
    "stutter": _stutter,
}


def cascade(texts: Texts, order: list[str]) -> np.ndarray:
    """Texts that no rule rejects; a rule runs on what the earlier ones left."""
    alive = np.flatnonzero(~texts.base_failed())
    now = texts
    for name in order:
        if not len(alive):
            break
        now = now.subset(alive if now is texts else kept)
        kept = np.flatnonzero(~RULES[name](now))
        alive = alive[kept]
    out = np.zeros(len(texts.off) - 1, bool)
    out[alive] = True
    return out


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in C.byte_slices(batch, "text"):
            texts = Texts(part.column(0)).measure()
            for name, rule in RULES.items():
                began = time.perf_counter()
                rejected = int(rule(texts.subset(np.arange(part.num_rows))).sum())
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([time.perf_counter() - began]), pa.array([rejected])],
                                                 names=["rule", "seconds", "rejected"])


def rule_order(texts: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rules by rejections per second on a sample of a one-column frame ``text``."""
    n = texts.count()
    sample = texts.sample(min(1.0, 1.2 * sample_rows / max(n, 1)), seed=11).limit(sample_rows)
    seen = sample.mapInArrow(_profile, "rule string, seconds double, rejected long").groupBy("rule").agg(F.sum("rejected"), F.sum("seconds"))
    worth = {rule: rejected / max(seconds, 1e-9) for rule, rejected, seconds in seen.collect()}
    return sorted(RULES, key=lambda r: -worth.get(r, 0.0))


def judge_quality(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with the base metrics ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed`` and the
    verdict ``kept``."""
    C.prepared(docs.sparkSession)
    order = rule_order(docs.select(F.col(f"`{text_col}`").alias("text")), sample_rows)
    metrics = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def compute(column: pa.Array) -> list[pa.Array]:
        texts = Texts(column).measure()
        return [*[pa.array(texts.base[m].astype(np.int64)) for m in metrics], pa.array(texts.base_failed()), pa.array(cascade(texts, order))]

    fields = [T.StructField(m, T.LongType()) for m in metrics] + [T.StructField(m, T.BooleanType()) for m in ("base_failed", "kept")]
    return C.add_columns(docs, text_col, compute, fields)

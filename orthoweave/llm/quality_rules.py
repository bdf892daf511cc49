"""Quality rules, line first: lines are judged alone, failing lines go, and a document
that loses too much of its text goes as a whole."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orthoweave.llm.common import BLANKS

#: Characters that may end a line of prose.
TERMINAL = ".!?:;\"')]”’»…。！？"
#: Separators of menus and breadcrumb trails, as words of their own.
SEPARATORS = ("|", "/", ">", "»", "›", "·", "•")
#: Phrases of page furniture, searched in the lower-cased line.
BOILERPLATE = (
    "accept cookies", "all rights reserved", "back to top", "click here", "cookie policy",
    "enable javascript", "log in to", "privacy policy", "sign up for", "skip to content",
    "terms of service", "terms of use",
)
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
MAX_MARKED_PERCENT = 20
MAX_LOST_PERCENT = 50

_SYMBOL = re.compile(r"[#*$%&|<>]")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def repeated_words(words: list) -> int:
    """Words that lie in a window of eight words found twice or more. Windows are
    numbered by joining numbers of windows half as long, so no text is hashed."""
    if len(words) < 9:
        return 0
    index: dict = {}
    codes = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    kinds = len(index)
    for half in (1, 2, 4):
        pairs = codes[:-half] * kinds + codes[half:]
        found, codes, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        kinds = len(found)
        if kinds == len(pairs):
            return 0
    change = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(counts[codes] > 1)
    change[starts] += 1
    change[starts + 8] -= 1
    return int(np.count_nonzero(np.cumsum(change[:-1]) > 0))


def line_passes(line: str, words: list[str]) -> bool:
    """Rules for one line that has words: its last character ends a sentence, it is no
    menu, it holds no furniture phrase, and few of its words carry marks at the end."""
    if line.rstrip(BLANKS)[-1] not in TERMINAL:
        return False
    n = len(words)
    bars = sum(w in SEPARATORS for w in words)
    if bars >= 2 and 100 * bars > MAX_MARKED_PERCENT * n:
        return False
    marked = sum(w[-1] in SYMBOLS or w[-2:] == "!!" for w in words)
    if 100 * marked > MAX_MARKED_PERCENT * n:
        return False
    low = line.translate(_LOWER)
    return not any(phrase in low for phrase in BOILERPLATE)


def judge(text: str | None) -> dict:
    """All figures of one document and the text that is left of it."""
    text = text or ""
    kept_lines, seen = [], set()
    duplicates = removed = lost = n_lines = 0
    words: list[str] = []
    for line in text.split("\n"):
        own = _split(line)
        if not own:
            kept_lines.append(line)
            continue
        n_lines += 1
        words += own
        duplicates += line in seen
        seen.add(line)
        if line_passes(line, own):
            kept_lines.append(line)
        else:
            removed += 1
            lost += len(own)
    n = len(words)
    repeated = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * n
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(_SYMBOL.findall(text)),
        "n_dup_lines": duplicates, "n_repeat_words": repeated, "base_failed": failed,
        "n_lines": n_lines, "n_removed_lines": removed, "n_lost_words": lost,
        "kept": not failed and 100 * lost <= MAX_LOST_PERCENT * n,
        "clean_text": "\n".join(kept_lines),
    }


def _split(line: str) -> list[str]:
    """Words between ASCII blanks; str.split() alone would also cut at other blanks."""
    return [w.decode("utf-8", "surrogatepass") for w in line.encode("utf-8", "surrogatepass").split()]


_FIELDS = {
    "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(), "n_repeat_words": pa.int64(), "base_failed": pa.bool_(),
    "n_lines": pa.int64(), "n_removed_lines": pa.int64(), "n_lost_words": pa.int64(),
    "kept": pa.bool_(), "clean_text": pa.string(),
}
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, n_lines long, n_removed_lines long, "
    "n_lost_words long, kept boolean, clean_text string")


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its figures, the verdict and the text of the lines kept.

    Only the id and the text are read, so further columns cannot clash. A null or
    empty text has zero words and fails the base rules; a null id stays null; repeated
    rows are judged each for itself; an empty table gives no rows. Texts of any length
    are judged whole; no row leaves its task, so there is no shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(t) for t in batch.column(1).to_pylist()]
            arrays = [batch.column(0)] + [pa.array([r[k] for r in rows], kind) for k, kind in _FIELDS.items()]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *_FIELDS])

    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(run, SCHEMA)

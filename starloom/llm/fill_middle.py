"""Fill-in-the-middle: texts cut at two unit borders and written with marks, so that a model learns to fill gaps.

A unit is whatever the pattern says, one code point by default. One ``fullmatch`` of ``(unit)*`` by the regex library
keeps every repetition of its group: ``ends(1)`` has as many entries as the text has units, and the entries in front of
the two cuts are their offsets, so no loop over units is needed. Cuts and form come from a hash of the row's id, hence a
task that runs twice writes the same text.

Each row is handled by itself: there is no shuffle, and a task holds one text's units at a time.

Edge cases: a null text is an empty one; an empty text, one that contains a mark, and one that does not consist of units
(``n`` is null then) stay plain; a null ``doc_id`` is hashed as an empty one; repeated rows give equal rows; a very long
text takes about 60 bytes of memory per unit while it is cut; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.text import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CODE_POINT = "."
PLAIN_PERCENT, SPM_PERCENT = 10, 20

_OUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def draws(doc_id: int | None, salt: str) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 for a row."""
    digest = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def unit_pattern(unit: str) -> regex.Pattern:
    return regex.compile(f"({unit})*", regex.DOTALL)


def cut(text: str, pattern: regex.Pattern, one: int, two: int) -> tuple[int, int, int] | None:
    """Number of units, end of the prefix, end of the middle; None if the text does not consist of units."""
    found = pattern.fullmatch(text)
    if found is None:
        return None
    ends = found.ends(1)
    n = len(ends)
    low, high = sorted((one % (n + 1), two % (n + 1)))
    return n, ends[low - 1] if low else 0, ends[high - 1] if high else 0


def arrange(text: str, doc_id: int | None, pattern: regex.Pattern, salt: str, plain_percent: int, spm_percent: int) -> tuple:
    """``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of one text."""
    h1, h2, h3, h4 = draws(doc_id, salt)
    places = cut(text, pattern, h1, h2)
    n = None if places is None else places[0]
    marked = any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
    if not text or marked or places is None or h3 % 100 >= 100 - plain_percent:
        return n, "plain", None, None, text
    _, a, b = places
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _arranged(unit: str, salt: str, plain_percent: int, spm_percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = unit_pattern(unit)
        for b in slices(batches):
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            rows = [arrange(t or "", i, pattern, salt, plain_percent, spm_percent) for i, t in zip(ids, texts, strict=True)]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], [c.split()[0] for c in _OUT.split(", ")])

    return run


def transform(
    docs: DataFrame,
    unit: str = CODE_POINT,
    salt: str = "1",
    plain_percent: int = PLAIN_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``).

    ``doc_id``, ``n`` (units), ``form`` (``plain``, ``psm``: prefix, suffix, middle, or ``spm``: suffix, prefix, middle),
    ``prefix_chars`` and ``middle_chars`` (code points, null if plain), and ``output``.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_arranged(unit, salt, plain_percent, spm_percent), _OUT)


def restored(output: Column, form: Column) -> Column:
    """The text from ``output`` and ``form``; parts hold no mark, so each mark is found where it was written."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)

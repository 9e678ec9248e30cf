"""Fill-in-the-middle: texts cut at units that a wavelet matrix over character classes counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crmtide.llm.common import chunks, table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of all texts that may be transformed, and percent of those with the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
SEED = 1
#: A byte's class adds 1 where a code point starts, 2 where a word does and 4 where a line does.
LEVELS = 3
UNITS = {"chars": (1, 3, 5, 7), "words": (3, 7), "lines": (5, 7)}
_CHUNK = 4_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class of each byte of texts that follow each other and begin at ``starts``."""
    lead, space = (data & 0xC0) != 0x80, _SPACE[data]
    after_space, after_line = np.empty(len(data), bool), np.empty(len(data), bool)
    after_space[1:], after_line[1:] = space[:-1], data[:-1] == 10
    first = starts[starts < len(data)]
    after_space[first] = after_line[first] = True
    return lead + 2 * (lead & ~space & after_space) + 4 * (lead & after_line).astype(np.uint8)


class WaveletMatrix:
    """Counts of each class before any place, from one bit a value and level and a sum for every 64 bits."""

    def __init__(self, values: np.ndarray, levels: int = LEVELS) -> None:
        self.levels: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        for shift in reversed(range(levels)):
            ones = (values >> shift & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(ones) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            sums = np.append(0, np.cumsum(np.bitwise_count(words), dtype=np.int64))
            self.levels.append((shift, words, sums, len(ones) - int(sums[-1])))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _ones(words: np.ndarray, sums: np.ndarray, at: np.ndarray) -> np.ndarray:
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return sums[at >> 6] + np.bitwise_count(words[at >> 6] & below)

    def rank(self, value: int, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` values are ``value``, for each of ``at``."""
        start, end = np.zeros(1, np.int64), at
        for shift, words, sums, zeros in self.levels:
            ones = [self._ones(words, sums, x) for x in (start, end)]
            if value >> shift & 1:
                start, end = zeros + ones[0], zeros + ones[1]
            else:
                start, end = start - ones[0], end - ones[1]
        return end - start

    def count(self, values: Sequence[int], at: np.ndarray) -> np.ndarray:
        return sum(self.rank(v, at) for v in values)

    def select(self, values: Sequence[int], number: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Place in [low, high) of the value that is the ``number``-th from the first of all, by bisection on ranks."""
        low, high = low.copy(), high.copy()
        while (open_ := np.nonzero(low < high)[0]).size:
            middle = (low[open_] + high[open_]) >> 1
            enough = self.count(values, middle + 1) >= number[open_]
            high[open_] = np.where(enough, middle, high[open_])
            low[open_] = np.where(enough, low[open_], middle + 1)
        return low


def cut(data: np.ndarray, bounds: np.ndarray, h1: np.ndarray, h2: np.ndarray, unit: str) -> tuple[np.ndarray, ...]:
    """(units, units and bytes before the first cut, the same before the second) of texts data[bounds[i]:bounds[i + 1]]."""
    begin, end = bounds[:-1], bounds[1:]
    matrix, of = WaveletMatrix(classes(data, begin)), UNITS[unit]
    before = matrix.count(of, begin)
    n = matrix.count(of, end) - before
    a, b = h1 % (n + 1), h2 % (n + 1)
    found = [n]
    for units in (np.minimum(a, b), np.maximum(a, b)):
        place = np.where(units == n, end, begin)
        inner = np.nonzero((units > 0) & (units < n))[0]
        place[inner] = matrix.select(of, (before + units + 1)[inner], begin[inner], end[inner])
        found += [units, place - begin]
    return tuple(found)


def _cutter(unit: str) -> Callable:
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).fill_null(b"")
            lengths = pc.binary_length(texts).to_numpy()
            h1, h2, plain, suffix_first = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4, 5))
            for lo, hi in chunks(lengths, _CHUNK):
                raw = texts.slice(lo, hi - lo).to_pylist()
                bounds = np.append(0, np.cumsum(lengths[lo:hi], dtype=np.int64))
                data = np.frombuffer(b"".join(raw), np.uint8)
                n, units_a, a, units_b, b = cut(data, bounds, h1[lo:hi], h2[lo:hi], unit)
                forms, outputs = [], []
                for t, x, y, as_is, spm in zip(raw, a, b, plain[lo:hi], suffix_first[lo:hi]):
                    if as_is or not t or any(mark in t for mark in marks):
                        forms.append("plain")
                        outputs.append(t)
                    elif spm:
                        forms.append("spm")
                        outputs.append(b"".join([s, t[y:], p, t[:x], m, t[x:y]]))
                    else:
                        forms.append("psm")
                        outputs.append(b"".join([p, t[:x], s, t[y:], m, t[x:y]]))
                form = pa.array(forms, pa.string())
                void = np.array([f == "plain" for f in forms], bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(n, pa.int64()),
                        form,
                        pa.array(units_a, pa.int64(), mask=void),
                        pa.array(units_b - units_a, pa.int64(), mask=void),
                        pa.array(outputs, pa.binary()).cast(pa.string(), safe=False),
                    ],
                    ["id", "n", "form", "prefix_units", "middle_units", "output"],
                )

    return transform


def draws(id_column: str, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers that the seed and a row's id decide; a NULL id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", unit: str = "chars", seed: int = SEED
) -> DataFrame:
    """(id, n, form, prefix_units, middle_units, output) for each row of ``docs``.

    A text of n units (``chars``: code points; ``words``; ``lines``) is cut
    twice, after numbers of units that its id and the seed decide. Form ``psm``
    is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` puts ``<S>`` suffix first,
    ``plain`` is the text itself: for texts that are NULL (taken as empty), empty
    or hold one of the marks, and for every tenth of the others; its unit counts
    are NULL. White space belongs to the unit before it, at a text's start to
    the prefix. Rows with equal ids are cut by the same draws, a NULL id draws
    as an empty one; repeated rows are all returned. A text is worked on whole,
    in some ten times its bytes of memory; batches are cut by bytes. Other
    columns are ignored; an empty table gives no rows. Ids are integers.
    """
    h1, h2, h3, h4 = draws(id_column, seed)
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(text_column).cast("string").alias("text"),
        h1.alias("h1"),
        h2.alias("h2"),
        (h3 % 100 >= TRANSFORMED).alias("plain"),
        (h4 % 100 < SUFFIX_FIRST).alias("suffix_first"),
    )
    schema = "id long, n long, form string, prefix_units long, middle_units long, output string"
    return rows.mapInArrow(_cutter(unit), schema).withColumnRenamed("id", id_column)


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` was given: no piece holds a mark, so the first of each kind is the one put in."""
    between = lambda start, end: F.substring_index(F.substring_index(output, end, 1), start, -1)
    spm = form == "spm"
    prefix = F.when(spm, between(PREFIX, MIDDLE)).otherwise(between(PREFIX, SUFFIX))
    suffix = F.when(spm, between(SUFFIX, PREFIX)).otherwise(between(SUFFIX, MIDDLE))
    middle = F.substring_index(output, MIDDLE, -1)
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id",
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
k AS (SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
           OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
         WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
c AS (SELECT doc_id, n, form, t, least(a, b) AS x, greatest(a, b) AS y FROM k),
p AS (SELECT *, t[1:x] AS prefix, substr(t, x + 1, y - x) AS middle, substr(t, y + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""

"""Passages that repeat across documents.

Alike ones by paragraph MinHash banding, exact verification and components;
equal ones of ``WINDOW`` words or more by their windows, wherever they start.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from crmtide.llm.common import WORD, forget, lean, remove, saved, table
from crmtide.llm.components import components
from crmtide.llm.words import SHINGLE, hashed, hashes, lowered, mix, shingles, similar

#: One row a band finds a pair of similarity 0.75 with probability 1 - 0.25 ** 6 = 0.9998, equal ones always.
BANDS = 6
#: Bits of a band's least hash. With 32, among the 70 million paragraphs of 6 GB one in ten would share a band by chance.
BITS = 42
#: The first paragraphs' hashes are kept in so many numbers, whose low bits hold the parts of the others.
_WHOLE, _LOW = 4, 64 - BITS
_PART = BITS * (BANDS - _WHOLE) // _WHOLE
#: Band keys, and what shares one, are shuffled in so many turns, which need not be on disk together.
BAND_TURNS, LINK_TURNS = 3, 2
SENTENCE, LONG, REACH = 6, 48, 12
#: Words in a row that must repeat for a passage to be removed.
PASSAGE = 20
#: Every run of WINDOW words that two documents share is found; its least run of SEED words tells where to look.
WINDOW, SEED = 50, 20
BLOCK = 512
_CHUNK = 2_000_000
_BASE = 0x9E3779B97F4A7C15
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?")] = True


def _anchors(word: np.ndarray) -> np.ndarray:
    """Places before which a long run without sentence ends is cut: minima of word-pair hashes within reach."""
    pair = mix(word[:-1] ^ mix(word[1:], 5), 6)
    wide = np.concatenate([np.zeros(REACH, np.uint64), pair, np.zeros(REACH, np.uint64)])
    view = np.lib.stride_tricks.sliding_window_view(wide, 2 * REACH + 1)
    low = (pair < view[:, :REACH].min(axis=1)) & (pair <= view[:, REACH + 1 :].min(axis=1))
    return np.nonzero(low)[0]


def _words(texts: Sequence[bytes]) -> tuple[list[bytes], np.ndarray, list[int], list[int]]:
    """(words of all texts, their hashes, ends of lines, ends of texts)."""
    words: list[bytes] = []
    ends, text_ends = [], []
    for t in texts:
        for line in t.split(b"\n"):
            words += line.split()
            ends.append(len(words))
        text_ends.append(len(words))
    return words, hashes(words), ends, text_ends


def paragraphs(texts: Sequence[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words of all texts, their hashes, then of each paragraph: text, first word, end), words lowered."""
    words, word, ends, text_ends = _words(texts)
    return words, word, *_cut(words, word, ends, text_ends)


def _cut(words: list[bytes], word: np.ndarray, ends: list[int], text_ends: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end) of each paragraph.

    A paragraph ends where a line or a sentence of ``SENTENCE`` words or more
    does; shorter sentences belong to the next. Only the words around decide, so
    a passage set into other text falls into the same paragraphs there, but for
    those at its ends. A run of over ``LONG`` words is cut at minima of a hash
    that leave ``SENTENCE`` words on both sides. The last words of a text that
    are fewer belong to the paragraph before, so no word is left out but those
    of texts under ``SENTENCE`` words.
    """
    last = np.frombuffer(bytes(map(itemgetter(-1), words)), np.uint8)
    stop = np.zeros(len(words) + 1, bool)
    stop[1:] = _STOPS[last]
    stop[ends] = True
    final = np.zeros(len(words) + 1, bool)
    final[text_ends] = True
    at = np.nonzero(stop[1:])[0] + 1
    long_enough = np.diff(at, prepend=0) >= SENTENCE
    end = at[long_enough | final[at]]
    before = np.nonzero(np.diff(end, prepend=0) < SENTENCE)[0] - 1
    end = np.delete(end, before[(before >= 0) & ~final[end[before]]])
    start = np.concatenate([[0], end[:-1]]) if len(end) else end
    more = [(a, b, a + _anchors(word[a:b])) for a, b in zip(start, end) if b - a > LONG]
    end = np.unique(np.concatenate([end, *[m[(m - a >= SENTENCE) & (b - m >= SENTENCE)] for a, b, m in more]])) if more else end
    start = np.concatenate([[0], end[:-1]]) if len(end) else end
    enough = end - start >= SENTENCE
    start, end = start[enough], end[enough]
    return np.searchsorted(np.array(text_ends, np.int64), start, "right"), start, end


def _over(ufunc, values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """``ufunc`` over values[start:stop] of each pair."""
    padded = np.append(values, values[-1:])
    return ufunc.reduceat(padded, np.column_stack([start, stop]).ravel())[::2]


def prints(run: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return _over(np.add, mix(run, 77), start, end - SHINGLE + 1).view(np.int64)


def _signature(run: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits a paragraph that tell which of 64 kinds of shingles it has."""
    return _over(np.bitwise_or, np.uint64(1) << (run >> np.uint64(58)), start, end - SHINGLE + 1)


_LEAST = [f"m{j}" for j in range(_WHOLE)]


def _packed(low: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The high ``BITS`` of each band's least hash: a number for each of the first bands, with a part of a later one below."""
    high, per = [x >> np.uint64(_LOW) for x in low], BITS // _PART
    part = lambda j: high[_WHOLE + j // per] >> np.uint64(_PART * (per - 1 - j % per)) & np.uint64((1 << _PART) - 1)
    return [(high[j] << np.uint64(_LOW) | part(j)).view(np.int64) for j in range(_WHOLE)]


def _nested(columns: dict[str, np.ndarray], owner: np.ndarray, n: int) -> pa.ListArray:
    """A list of structs for each of ``n`` rows."""
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(c) for c in columns.values()], list(columns))
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _segmenter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, tid, paragraphs, seeds): each paragraph's place, print and least hashes, two to a number; the windows' seeds."""
    for batch in batches:
        for a, b, raw in lowered(batch.column(2), _CHUNK):
            words, word, ends, text_ends = _words(raw)
            text, start, end = _cut(words, word, ends, text_ends)
            bounds = np.append(0, text_ends)
            run, stop = shingles(word), end - SHINGLE + 1
            found = {
                "start": (start - bounds[text]).astype(np.int32),
                "words": (end - start).astype(np.int32),
                "print": prints(run, start, end) if len(start) else np.empty(0, np.int64),
            }
            low = [_over(np.minimum, mix(run, 200 + j), start, stop) if len(start) else np.empty(0, np.uint64) for j in range(BANDS)]
            found |= dict(zip(_LEAST, _packed(low)))
            of, _, seed, _ = _windows(word, bounds)
            order = np.lexsort([seed, of])
            of, seed = of[order], seed[order]
            new = np.append(True, (of[1:] != of[:-1]) | (seed[1:] != seed[:-1]))[: len(of)]
            offsets = np.searchsorted(of[new], np.arange(b - a + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a),
                    batch.column(1).slice(a, b - a),
                    _nested(found, text, b - a),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(seed[new])),
                ],
                ["id", "tid", "paragraphs", "seeds"],
            )


def _step(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written down; what its shuffles took on disk is free again."""
    out = saved(df, purpose)
    forget(df.sparkSession)
    return out


def _segmented(rows: DataFrame) -> DataFrame:
    """A row per text of ``rows`` with its paragraphs and seeds."""
    low = ",".join(f"{m}:long" for m in _LEAST)
    schema = f"id long, tid long, paragraphs array<struct<start:int,words:int,print:long,{low}>>, seeds array<long>"
    return saved(rows.mapInArrow(lean(_segmenter), schema), "paragraphs")


def _keys(bands: Sequence[int]) -> Column:
    """A key for each of these bands, as ``_packed`` has laid them down; the bands of a key are told apart by its bits over ``BITS``."""
    per = BITS // _PART

    def least(j: int) -> Column:
        if j < _WHOLE:
            return F.shiftrightunsigned(_LEAST[j], _LOW)
        parts = [F.col(m).bitwiseAND(F.lit((1 << _PART) - 1)) for m in _LEAST[(j - _WHOLE) * per : (j - _WHOLE + 1) * per]]
        return reduce(lambda x, y: F.shiftleft(x, _PART).bitwiseOR(y), parts)

    return F.array(*[F.lit(j << BITS).cast("long").bitwiseOR(least(j)) for j in bands])


def _contexts(of: np.ndarray, at: np.ndarray, seed: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first window, content) of runs of neighbouring windows of a text with one seed."""
    new = np.append(True, (of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1) | (seed[1:] != seed[:-1]))
    first = np.nonzero(new)[0]
    turn = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
    return first, np.add.reduceat(mix(whole.view(np.uint64) ^ mix(turn.astype(np.uint64), 61), 62), first).view(np.int64)


_READ = "id long, tid long, start int, seed long, content long, windows array<long>, print long, bits long, shingles array<long>"


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is wanted of (id, tid, text, seeds, places): windows with these seeds, and the shingles of these paragraphs."""
    names = [c.split()[0] for c in _READ.split(", ")]
    for batch in batches:
        seeds, spans = batch.column(3), batch.column(4)
        for a, b, raw in lowered(batch.column(2), _CHUNK):
            word, bounds = hashed(raw)
            of, at, seed, whole = _windows(word, bounds)
            cuts = np.searchsorted(of, np.arange(b - a + 1))
            kept = [np.empty(0, np.int64)]
            for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
                if seeds[a + k].is_valid and hi > lo:
                    kept.append(lo + np.nonzero(np.isin(seed[lo:hi], seeds[a + k].values.to_numpy()))[0])
            kept = np.concatenate(kept)
            if len(kept):
                of, at, seed, whole = of[kept], at[kept], seed[kept], whole[kept]
                first, content = _contexts(of, at, seed, whole)
                own, n = pa.array(of[first] + a), len(first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(own),
                        batch.column(1).take(own),
                        pa.array(at[first].astype(np.int32)),
                        pa.array(seed[first]),
                        pa.array(content),
                        pa.ListArray.from_arrays(pa.array(np.append(first, len(of)).astype(np.int32)), pa.array(whole)),
                        *[pa.nulls(n, pa.int64())] * 2,
                        pa.nulls(n, pa.list_(pa.int64())),
                    ],
                    names,
                )
            listed = [(k, spans[a + k].values) for k in range(b - a) if spans[a + k].is_valid and len(spans[a + k].values)]
            if not listed:
                continue
            start = np.concatenate([bounds[k] + v.field("start").to_numpy() for k, v in listed])
            end = start + np.concatenate([v.field("words").to_numpy() for _, v in listed])
            run = shingles(word)
            own = [np.unique(run[x : y - SHINGLE + 1]) for x, y in zip(start, end)]
            n, none = len(start), pa.nulls(len(start), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    none,
                    none,
                    pa.nulls(n, pa.int32()),
                    none,
                    none,
                    pa.nulls(n, pa.list_(pa.int64())),
                    pa.array(np.concatenate([v.field("print").to_numpy() for _, v in listed])),
                    pa.array(_signature(run, start, end).view(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(np.append(0, np.cumsum([len(x) for x in own])).astype(np.int32)),
                        pa.array(np.concatenate(own).view(np.int64)),
                    ),
                ],
                names,
            )


class _Sets:
    """Sorted shingles of paragraphs, one after the other, with the 64 bits that tell their kinds."""

    def __init__(self, column: pa.ListArray, bits: np.ndarray) -> None:
        offsets = column.offsets.to_numpy()
        self.values = column.values.to_numpy().view(np.uint64)
        self.start, self.size, self.bits = offsets[:-1], np.diff(offsets), bits.view(np.uint64)

    def __getitem__(self, at: int) -> np.ndarray:
        return self.values[self.start[at] : self.start[at] + self.size[at]]

    def may_link(self, x, y) -> np.ndarray:
        """Pairs that the bits do not rule out: what one has and the other lacks bounds the similarity from above."""
        lacks = np.bitwise_count(self.bits[x] & ~self.bits[y]).astype(int)
        lacked = np.bitwise_count(self.bits[y] & ~self.bits[x]).astype(int)
        both = np.minimum(self.size[x] - lacks, self.size[y] - lacked)
        return (100 * both >= 75 * (both + lacks + lacked)) & (both > 0)

    def linked(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Pairs with a Jaccard similarity of 0.75 or more, many at once: shingles that a pair holds twice are in both."""
        size = np.column_stack([self.size[x], self.size[y]]).ravel()
        start = np.column_stack([self.start[x], self.start[y]]).ravel()
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
        pair = np.repeat(np.arange(len(x)), self.size[x] + self.size[y])
        order = np.lexsort([self.values[at], pair])
        values, pair = self.values[at][order], pair[order]
        same = (values[1:] == values[:-1]) & (pair[1:] == pair[:-1])
        both = np.bincount(pair[1:][same], minlength=len(x))
        return 100 * both >= 75 * (self.size[x] + self.size[y] - both)


def _links(group: pa.RecordBatch, whole: _Sets, base: int) -> list[tuple[int, int]]:
    """Verified links between the paragraphs of one block or two of a band value that connect what isn't connected."""
    block, i, j, names = (group.column(c).to_numpy() for c in ("block", "i", "j", "print"))
    first, second, alone = np.nonzero(block == i[0])[0], np.nonzero(block == j[0])[0], i[0] == j[0]
    part = np.arange(group.num_rows)
    found = []
    for x in first:
        y = second[second > x] if alone else second
        y = y[part[y] != part[x]]
        if not len(y):
            continue
        for at in y[whole.may_link(base + x, base + y)]:
            if part[at] != part[x] and similar(whole[base + x], whole[base + at]):
                found.append((names[x], names[at]))
                part[part == part[at]] = part[x]
    return found


#: Groups of so many paragraphs at most are compared many at once, pair by pair.
_SMALL = 8


def _small_links(starts: np.ndarray, sizes: np.ndarray, names: np.ndarray, whole: _Sets) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified links of groups that are one block each, all pairs of all groups of one size together."""
    for m in np.unique(sizes):
        at = starts[sizes == m]
        x, y = np.triu_indices(m, 1)
        x, y = (at[:, None] + x).ravel(), (at[:, None] + y).ravel()
        near = whole.may_link(x, y)
        x, y = x[near], y[near]
        if len(x):
            linked = whole.linked(x, y)
            yield names[x[linked]], names[y[linked]]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of all groups (key, i, j) of a partition that is sorted by them; one group is held beyond its batch."""
    rest = None

    def links(table: pa.RecordBatch, cuts: np.ndarray) -> pa.RecordBatch:
        whole = _Sets(table.column("shingles"), table.column("bits").to_numpy())
        names, i, j = (table.column(c).to_numpy() for c in ("print", "i", "j"))
        starts, sizes = cuts[:-1], np.diff(cuts)
        small = (sizes > 1) & (sizes <= _SMALL) & (i[starts] == j[starts])
        found = list(_small_links(starts[small], sizes[small], names, whole))
        for a, b in zip(starts[~small & (sizes > 1)], cuts[1:][~small & (sizes > 1)]):
            if more := _links(table.slice(a, b - a), whole, a):
                found.append(tuple(np.array(more, np.int64).T))
        columns = [np.concatenate([np.empty(0, np.int64), *[f[k] for f in found]]) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b"])

    for batch in filter(len, batches):
        table = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        new = np.zeros(table.num_rows, bool)
        for c in ("key", "i", "j"):
            values = table.column(c).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        cuts = np.append(0, np.nonzero(new)[0])
        if len(cuts) > 1:
            yield links(table, cuts)
        rest = pa.RecordBatch.from_arrays([pa.concat_arrays([c.slice(cuts[-1])]) for c in table.columns], schema=table.schema)
    if rest is not None and rest.num_rows:
        yield links(rest, np.array([0, rest.num_rows]))


def _runs(word: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """For each size a hash of so many words in a row, at each place where they fit."""
    powers = lambda base: np.multiply.accumulate(np.append(np.uint64(1), np.full(len(word), base, np.uint64)))
    up, down = powers(_BASE), powers(pow(_BASE, -1, 1 << 64))
    total = np.append(np.uint64(0), np.cumsum(word * down[:-1]))
    return [mix((total[n:] - total[:-n]) * up[: len(total) - n], n) for n in sizes]


def _windows(word: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, seed, hash) of every ``WINDOW`` words in a row; the seed is their least hash of ``SEED`` words.

    Equal windows have equal seeds, whatever surrounds them, and neighbours
    mostly share theirs: there is about one seed for 16 words.
    """
    if len(word) < WINDOW:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    seed, whole = _runs(word, SEED, WINDOW)
    reach, wide = WINDOW - SEED + 1, 1
    while wide < reach:
        step = min(wide, reach - wide)
        seed = np.minimum(seed[:-step], seed[step:])
        wide += step
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.nonzero(text[: len(whole)] == text[WINDOW - 1 :])[0]
    return text[at], at - bounds[text[at]], seed[at].view(np.int64), whole[at].view(np.int64)


def _wanted_seeds(parts: DataFrame) -> DataFrame:
    """(id, tid, seeds) of the seeds that texts share; of equal texts only the one with the smallest id is named."""
    seeds = parts.select("id", "tid", F.explode("seeds").alias("seed"))
    shared = seeds.groupBy("seed").agg(F.min("tid").alias("x"), F.max("tid").alias("y")).filter("x <> y").select("seed")
    return seeds.join(shared, "seed", "left_semi").groupBy("tid").agg(F.min("id").alias("id"), F.collect_set("seed").alias("seeds"))


_PLACES = "array<struct<print:long,start:int,words:int>>"


def _read(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Windows and paragraphs' shingles that ``wanted`` (id, tid, seeds, places) lists, from one pass over its texts."""
    texts = rows.join(wanted, ["id", "tid"]).select("id", "tid", "text", "seeds", "places")
    return _step(texts.mapInArrow(lean(_reader), _READ), "read")


def _repeated(read: DataFrame) -> DataFrame:
    """(id, tid, start, end, kept_id): runs of windows that a smaller id has too.

    Windows come in contexts, runs with one seed. Where all contexts of a seed
    are equal, the smallest id keeps them; otherwise each window is looked at.
    """
    found = read.filter("seed is not null").select("id", "tid", "start", "seed", "content", "windows")
    classes = found.groupBy("seed", "content").agg(F.min("id").alias("kept_id"), F.max("id").alias("top"))
    seeds = classes.groupBy("seed").agg(F.count(F.lit(1)).alias("k"), F.min("kept_id").alias("kept_id"), F.max("top").alias("top"))
    seeds = _step(seeds.filter("kept_id <> top").drop("top"), "repeated-seeds")
    ends = found.select("id", "tid", "start", (F.col("start") + F.size("windows") - 1 + WINDOW).alias("end"), "seed")
    equal = ends.join(seeds.filter("k = 1"), "seed").filter("id <> kept_id").select("id", "tid", "start", "end", "kept_id")
    place = F.posexplode("windows").alias("turn", "window")
    several = found.join(seeds.filter("k > 1"), "seed", "left_semi").select("id", "tid", "start", place)
    several = several.select("id", "tid", (F.col("start") + F.col("turn")).alias("start"), "window")
    owners = several.groupBy("window").agg(F.min("id").alias("kept_id"), F.max("id").alias("top")).filter("kept_id <> top")
    gone = several.join(owners.drop("top"), "window").filter("id <> kept_id")
    gone = gone.select("id", "tid", "start", (F.col("start") + WINDOW).alias("end"), "kept_id")
    out = _step(equal.unionByName(gone), "equal-passages")
    remove(seeds)
    return out


def repeated_windows(rows: DataFrame) -> DataFrame:
    """(id, tid, start, end, kept_id) of every ``WINDOW`` words of ``rows`` (id, tid, text) that a smaller id has too.

    Of rows with the same text, only the one with the smallest id is looked at.
    A window is hashed only if another text has its seed. Windows are equal if
    their seeds' and their own 64-bit hashes are.
    """
    wanted = _wanted_seeds(_segmented(rows)).withColumn("places", F.lit(None).cast(_PLACES))
    runs = _repeated(_read(rows, wanted))
    each = F.explode(F.sequence("start", F.col("end") - WINDOW)).alias("start")
    return runs.select("id", "tid", each, "kept_id").select("id", "tid", "start", (F.col("start") + WINDOW).alias("end"), "kept_id")


def _members(distinct: DataFrame, bands: Sequence[int]) -> DataFrame:
    """(print, key, blocks) of the values of these bands that several prints (print, x, y) of more than one document have."""
    keyed = distinct.select("print", "x", "y", F.explode(_keys(bands)).alias("key"))
    keys = keyed.groupBy("key").agg(F.min("x").alias("x"), F.max("y").alias("y"), F.count(F.lit(1)).alias("m"))
    shared = keys.filter("x <> y and m > 1").select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    return _step(keyed.select("print", "key").join(shared, "key"), "band-members")


def _linked(members: DataFrame, read: DataFrame, turn: int) -> DataFrame:
    """(a, b): links between prints that share a band value, of the values whose turn it is."""
    texts = read.filter("print is not null").groupBy("print").agg(F.first("bits").alias("bits"), F.first("shingles").alias("shingles"))
    dealt = (
        members.filter(F.pmod(F.xxhash64("key"), F.lit(LINK_TURNS)) == turn)
        .join(texts, "print")
        .withColumn("block", F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    )
    group = ["key", "i", "j"]
    dealt = dealt.select(*group, "block", "print", "bits", "shingles").repartition(*group).sortWithinPartitions(*group)
    return _step(dealt.mapInArrow(lean(_compare), "a long, b long").distinct(), "paragraph-links")


def repeated_passages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_words: int = PASSAGE
) -> DataFrame:
    """(id, tid, start, end, n_words, kept_id): passages to remove, as words [start, end) of the row's text.

    Paragraphs (see ``paragraphs``) whose five-word
    shingles have a Jaccard similarity of 0.75 or more link, in lower case.
    Of each component that lies in several documents, the document with the
    smallest id keeps all it has; in the others it goes, if ``least_words``
    in a row go; spans that touch are one. ``WINDOW`` words in a row that a document with a smaller id has
    too go wherever they start and end. ``tid`` is xxhash64 of the text and tells rows with the same id
    apart; rows that repeat an id count as one document. NULL or empty
    texts have no paragraph; rows with a NULL id neither lose nor keep anything.
    Other columns are ignored; an empty table gives no rows. A text is cut and
    hashed whole, however long, in some fifty times its bytes of memory.

    Equal paragraphs, by a 64-bit hash of their shingles, are one in all that
    follows. Those none of whose band values occurs in two documents are dropped
    first, two bands at a time. The texts of the others and the windows worth a
    look are read in one further pass over the documents that hold any; what
    shares a band value is compared in blocks, half of the values at a time, so no
    list of pairs is made.
    """
    rows = docs.filter(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"),
        F.xxhash64(F.col(text_column).cast("string")).alias("tid"),
        F.col(text_column).cast("string").alias("text"),
    )
    parts = _segmented(rows)
    found = parts.select("id", "tid", F.inline("paragraphs"))
    least = [F.first(m).alias(m) for m in _LEAST]
    distinct = _step(found.groupBy("print").agg(F.min("id").alias("x"), F.max("id").alias("y"), *least), "prints")
    members = reduce(DataFrame.unionByName, [_members(distinct, range(k, BANDS, BAND_TURNS)) for k in range(BAND_TURNS)])
    equal = distinct.filter("x <> y").select("print")
    sharing = _step(members.select("print").unionByName(equal).distinct(), "sharing")
    remove(distinct)
    some = _step(found.select("id", "tid", "start", "words", "print").join(sharing, "print", "left_semi"), "shared-paragraphs")
    remove(sharing)
    seeds = _step(_wanted_seeds(parts), "shared-seeds")
    remove(parts)

    place = F.struct("id", "tid", "start", "words")
    compared = members.select("print").distinct()
    owners = some.join(compared, "print", "left_semi").groupBy("print").agg(F.min(place).alias("at"))
    owners = owners.select("at.id", "at.tid", F.struct("print", "at.start", "at.words").alias("one"))
    wanted = owners.groupBy("id", "tid").agg(F.collect_list("one").alias("places"))
    read = _read(rows, seeds.join(wanted, ["id", "tid"], "full"))
    remove(seeds)
    links = reduce(DataFrame.unionByName, [_linked(members, read, k) for k in range(LINK_TURNS)])
    remove(members)
    roots = components(links).withColumnRenamed("node", "print")
    placed = some.select("id", "tid", "start", "words", "print").join(roots, "print", "left")
    placed = placed.withColumn("component", F.coalesce("component", "print"))
    owners = placed.groupBy("component").agg(F.min("id").alias("kept_id"), F.max("id").alias("top")).filter("kept_id <> top")
    gone = placed.join(owners.drop("top"), "component").filter("id <> kept_id")
    gone = gone.select("id", "tid", "start", (F.col("start") + F.col("words")).alias("end"), "kept_id")
    gone = _step(gone, "alike-passages")
    remove(some)
    gone = gone.unionByName(_repeated(read))
    remove(read)
    by = Window.partitionBy("id", "tid").orderBy("start", "end")
    until = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    gone = gone.withColumn("new", F.coalesce((F.col("start") > until).cast("int"), F.lit(1)))
    gone = gone.withColumn("passage", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    gone = gone.groupBy("id", "tid", "passage").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("kept_id").alias("kept_id"))
    gone = gone.withColumn("n_words", F.col("end") - F.col("start")).filter(F.col("n_words") >= least_words)
    return gone.select("id", "tid", "start", "end", "n_words", "kept_id")


_WORD = re.compile(WORD)


def _cut_out(text: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for t, gone in zip(text, spans):
        begins = [m.start() for m in _WORD.finditer(t)] + [len(t)]
        kept, at = [], 0
        for start, end in sorted((s["start"], s["end"]) for s in gone):
            kept.append(t[at : begins[start]])
            at = begins[end]
        out.append("".join([*kept, t[at:]]))
    return pd.Series(out)


# Otherwise a filter and a length of the text cut each text again, in workers of their own.
_without = F.pandas_udf(_cut_out, StringType()).asNondeterministic()


def remove_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the repeated passages cut out of their texts; a row of which no word is left goes.

    Rows that lose nothing are returned as they are. ``n_chars``, where there is
    such a column, follows the text.
    """
    spans = repeated_passages(docs, id_column, text_column)
    spans = spans.groupBy("id", "tid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    spans = saved(spans, "passages")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_column).cast("long").alias("id"),
        F.xxhash64(F.col(text_column).cast("string")).alias("tid"),
    )
    joined = rows.join(spans, ["id", "tid"], "left")
    text = F.col(f"row.{text_column}")
    cut = joined.filter("spans is not null").withColumn("row", F.col("row").withField(text_column, _without(text, "spans")))
    cut = cut.filter(text.rlike(WORD))
    if "n_chars" in docs.columns:
        length = F.char_length(text).cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("row", F.col("row").withField("n_chars", length))
    return joined.filter("spans is null").select("row.*").unionByName(cut.select("row.*"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "start", "end", "n_words", F.col("kept_id").alias("kept_doc_id"))

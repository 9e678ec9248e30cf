"""Repeated byte strings by longest-previous-factor arrays over suffixes that share an anchor."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crmtide.llm.common import chunks, remove, saved, table
from crmtide.llm.words import mix

LENGTH = 200
#: Bytes of an anchor: every string of LENGTH bytes is filed under the least hash of so many bytes in a row in it.
ANCHOR = 64
#: Bytes of the strings under one anchor that are put in suffix order together; beyond, they are filed anew by longer ones.
TOGETHER = 1 << 17
#: Bytes that are worked on at once; a longer text is worked on in such parts.
PART = 1 << 20
_INDEX = 21
_BASE = 0x9E3779B97F4A7C15
_OF_BYTE = np.random.default_rng(5).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=2)
def _powers(room: int) -> tuple[np.ndarray, np.ndarray]:
    of = lambda base: np.multiply.accumulate(np.append(np.uint64(1), np.full(room, base, np.uint64)))
    return of(_BASE), of(pow(_BASE, -1, 1 << 64))


class Hashes:
    """A 64-bit hash of any part of ``data``, equal for equal parts, from sums over its first bytes."""

    def __init__(self, data: np.ndarray) -> None:
        self.up, down = _powers(1 << max(int(len(data)).bit_length(), 12))
        self.sums = np.append(np.uint64(0), np.cumsum(_OF_BYTE[data] * down[: len(data)]))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.up[start] + (end - start).astype(np.uint64))

    def runs(self, size: int) -> np.ndarray:
        """Of every ``size`` bytes in a row."""
        return mix((self.sums[size:] - self.sums[:-size]) * self.up[: len(self.sums) - size] + np.uint64(size))


def _slide(ufunc, values: np.ndarray, reach: int) -> np.ndarray:
    """``ufunc`` over every ``reach`` values in a row."""
    wide = 1
    while wide < reach:
        step = min(wide, reach - wide)
        values = ufunc(values[:-step], values[step:])
        wide += step
    return values


def contexts(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, first start, starts, anchor, content, repeats) of runs of string starts with one anchor.

    Every ``length`` bytes of texts data[bounds[i]:bounds[i + 1]] have the anchor
    that is the least hash of ``ANCHOR`` bytes in them, so equal strings have equal
    anchors. Neighbours mostly share theirs; a context is a run of starts that
    do, ``content`` hashes all its bytes. ``repeats`` tells whether the anchor's
    bytes occur twice in it, without which no string of it can.
    """
    reach = length - ANCHOR + 1
    empty = np.empty(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64), empty.astype(bool)
    hashes = Hashes(data)
    run = hashes.runs(ANCHOR)
    least = _slide(np.minimum, run, reach)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.nonzero(text[: len(data) - length + 1] == text[length - 1 :])[0]
    if not len(at):
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64), empty.astype(bool)
    anchor, own = least[at], text[at]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1))
    first = at[new]
    n = np.diff(np.append(np.nonzero(new)[0], len(at)))
    # Where an anchor lies: bytes whose hash no string around them undercuts.
    wide = np.concatenate([np.zeros(reach - 1, np.uint64), least, np.zeros(reach - 1, np.uint64)])
    hit = np.nonzero(run == _slide(np.maximum, wide, reach))[0]
    pairs = np.append(0, np.cumsum((run[hit[1:]] == run[hit[:-1]]) & (hit[1:] - hit[:-1] <= reach)))
    low, high = np.searchsorted(hit, first), np.searchsorted(hit, first + n - 1 + reach)
    repeats = pairs[np.maximum(high - 1, low)] > pairs[np.minimum(low, len(pairs) - 1)]
    return own[new], first, n, anchor[new], hashes.of(first, first + n - 1 + length), repeats


class SuffixOrder:
    """Suffixes of ``data`` at ``starts``, ordered by their first ``length`` bytes, then by place.

    Ranks of 5 bytes are doubled until they reach the length; two sorted ranks and
    the place fit one 64-bit number. The ranks of each size stay, to compare by.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, length: int) -> None:
        n = len(data)
        if n >= 1 << _INDEX:
            raise ValueError("too many bytes for one suffix order")
        self.data, self.length = np.append(data, np.zeros(2 * length + 8, np.uint8)), length
        key = np.zeros(n, np.int64)
        for k in range(5):
            key = key << 8 | self.data[k : n + k]
        place = np.arange(n)
        self.ranks, size = [(5, self._rank(key << _INDEX | place, n)[0])], 5
        while size < length:
            step = min(size, length - size)
            rank = self.ranks[-1][1]
            of = place if size + step < length else starts
            pair = (rank[of].astype(np.int64) << _INDEX | rank[np.minimum(of + step, n)]) << _INDEX | of
            size += step
            last, order = self._rank(pair, n)
            self.ranks.append((size, last))
        self.order, self.last = order, last[order]

    @staticmethod
    def _rank(packed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        packed = np.sort(packed)
        order, key = packed & ((1 << _INDEX) - 1), packed >> _INDEX
        rank = np.zeros(n + 1, np.int32)
        rank[order] = np.cumsum(np.append(1, key[1:] != key[:-1]))
        return rank, order

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal first bytes of suffixes in places a and b of the data, up to the length."""
        n, out = len(self.ranks[0][1]) - 1, np.zeros(len(a), np.int64)
        whole = self.ranks[-1][1]
        out[whole[a] == whole[b]] = self.length
        open_ = np.nonzero(out < self.length)[0]
        for size, rank in reversed(self.ranks[:-1]):
            x, y = a[open_] + out[open_], b[open_] + out[open_]
            same = (rank[np.minimum(x, n)] == rank[np.minimum(y, n)]) & (x < n) & (y < n)
            out[open_[same]] += size
        for _ in range(4):
            x, y = a[open_] + out[open_], b[open_] + out[open_]
            open_ = open_[(self.data[x] == self.data[y]) & (x < n) & (y < n)]
            out[open_] += 1
        return np.minimum(out, self.length)


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value before each; -1 where there is none. Values are distinct."""
    found = np.arange(len(values)) - 1
    open_ = np.nonzero(found >= 0)[0]
    while len(open_):
        open_ = open_[values[found[open_]] > values[open_]]
        # All between a larger value and its own candidate are larger still.
        found[open_] = found[found[open_]]
        open_ = open_[found[open_] >= 0]
    return found


def longest_factors(order: SuffixOrder, later: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(place, length) for every suffix: its longest match, up to the order's length, with one in an earlier place.

    In suffix order the nearest suffix before and the nearest behind that lie
    earlier in the text match it longest. ``later`` matches with later places.
    """
    place = order.order
    by = -place if later else place
    before = previous_smaller(by)
    behind = len(by) - 1 - previous_smaller(by[::-1])[::-1]
    best = np.zeros(len(place), np.int64)
    for other, there in ((before, before >= 0), (behind, behind < len(by))):
        best[there] = np.maximum(best[there], order.common(place[there], place[other[there]]))
    return place, best


def _parts(batch: pa.RecordBatch, column: int, length: int) -> Iterator[tuple]:
    """(row, first byte, bytes, bounds) of parts of the texts; a part's strings start in its first ``PART`` bytes."""
    texts = batch.column(column).cast(pa.binary()).fill_null(b"")
    lengths = pc.binary_length(texts).to_numpy()
    for lo, hi in chunks(lengths, PART):
        raw = texts.slice(lo, hi - lo).to_pylist()
        if hi - lo == 1 and len(raw[0]) > PART:
            for at in range(0, len(raw[0]), PART):
                piece = raw[0][at : at + PART + length - 1]
                yield np.array([lo]), np.array([at]), np.frombuffer(piece, np.uint8), np.array([0, len(piece)])
        else:
            bounds = np.append(0, np.cumsum(lengths[lo:hi], dtype=np.int64))
            yield np.arange(lo, hi), np.zeros(hi - lo, np.int64), np.frombuffer(b"".join(raw), np.uint8), bounds


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _contexts_of(length: int) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, base, data, bounds in _parts(batch, 2, length):
                text, first, n, anchor, content, repeats = contexts(data, bounds, length)
                own = pa.array(row[text])
                start = first - bounds[text] + base[text]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(own),
                        batch.column(1).take(own),
                        pa.array(start.astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                        _signed(anchor),
                        _signed(content),
                        pa.array(repeats),
                    ],
                    ["id", "tid", "start", "n", "anchor", "content", "repeats"],
                )

    return find


def _snippets(length: int) -> Callable:
    """The bytes of the contexts listed beside a text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "tid", "anchor", "start", "n", "seen", "bytes"]
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for k, (t, wanted) in enumerate(zip(texts, batch.column(3))):
                listed = wanted.values
                start, n = (listed.field(c).to_numpy() for c in ("start", "n"))
                own = pa.array(np.full(len(start), k))
                pieces = [t[a : a + m - 1 + length] for a, m in zip(start, n)]
                columns = [batch.column(0).take(own), batch.column(1).take(own)]
                columns += [listed.field(c) for c in ("anchor", "start", "n", "seen")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(pieces, pa.binary())], names)

    return cut


def _whole_groups(batches: Iterator[pa.RecordBatch], key: str, most: int) -> Iterator[pa.Table]:
    """Tables of whole groups of neighbouring rows with one key, of about ``most`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in filter(len, batches):
        held.append(batch)
        size += batch.nbytes
        if size < most:
            continue
        got = pa.Table.from_batches(held).combine_chunks()
        keys = got[key].to_numpy()
        last = int(np.searchsorted(np.cumsum(np.append(0, keys[1:] != keys[:-1])), (keys[1:] != keys[:-1]).sum()))
        if last:
            yield got.slice(0, last)
        held = got.slice(last).to_batches()
        size = sum(b.nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _spans(rows: pa.Table, row: np.ndarray, at: np.ndarray, length: int) -> pa.RecordBatch:
    """Spans that string starts ``at`` of ``row``, in their order, cover; neighbours are one."""
    new = np.append(True, (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1))[: len(at)]
    end = at[np.append(new[1:], True)[: len(at)]] + length
    own = pa.array(row[new])
    took = lambda c: rows[c].combine_chunks().take(own) if isinstance(rows[c], pa.ChunkedArray) else rows[c].take(own)
    columns = [took("id"), took("tid"), pa.array(at[new].astype(np.int32)), pa.array(end.astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, ["id", "tid", "start", "end"])


def _starts(bounds: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in the data) of the string starts of all rows."""
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + bounds[row]


def _ordered(length: int, keep: str) -> Callable:
    """Spans of contexts whose strings occur elsewhere, for rows sorted by anchor, then place."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches, "anchor", PART):
            raw = rows["bytes"].to_pylist()
            n, seen, first = (rows[c].to_numpy() for c in ("n", "seen", "start"))
            key = rows["anchor"].to_numpy()
            cuts = np.append(np.nonzero(np.append(True, key[1:] != key[:-1]))[0], len(key))
            sizes = np.add.reduceat([len(t) for t in raw], cuts[:-1])
            for a, b in chunks(sizes, (1 << _INDEX) - 1 - TOGETHER - length):
                lo, hi = cuts[a], cuts[b]
                data = np.frombuffer(b"".join(raw[lo:hi]), np.uint8)
                bounds = np.append(0, np.cumsum([len(t) for t in raw[lo:hi]]))
                row, at = _starts(bounds, n[lo:hi])
                order = SuffixOrder(data, at, length)
                place, best = longest_factors(order)
                found = best >= length
                if keep == "none":
                    found |= longest_factors(order, later=True)[1] >= length
                marked = np.zeros(len(data), bool)
                marked[place[found]] = True
                gone = marked[at] & ((seen[lo:hi][row] == 1) | (keep == "first"))
                row, at = row[gone], at[gone]
                yield _spans(rows, row + lo, at - bounds[row] + first[lo:hi][row], length)

    return find


def _narrowed(length: int, level: int) -> Callable:
    """Contexts cut where the anchor's first place in their strings moves on from one share of all distances to the next.

    The distances from a string's start to its anchor are dealt over 2 ** ``level``
    shares. What the strings of one share have in common is longer than the anchor,
    by more at each level; ``key`` hashes it, and at the last level whole strings.
    Equal pieces that are cut at once show their bytes once.
    """
    edges = np.arange((1 << level) + 1) * (length - ANCHOR + 1) >> level

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "tid", "anchor", "seen", "key", "content", "start", "n", "bytes"]
        for batch in batches:
            raw = batch.column(6).to_pylist()
            anchor, first, n = (batch.column(c).to_numpy() for c in (2, 3, 4))
            sizes = np.array([len(t) for t in raw], np.int64)
            for lo, hi in chunks(sizes, PART):
                together = b"".join(raw[lo:hi])
                bounds = np.append(0, np.cumsum(sizes[lo:hi]))
                row, at = _starts(bounds, n[lo:hi])
                hashes = Hashes(np.frombuffer(together, np.uint8))
                run = hashes.runs(ANCHOR)
                hit = np.nonzero(run == np.repeat(anchor[lo:hi].view(np.uint64), sizes[lo:hi])[: len(run)])[0]
                place = hit[np.searchsorted(hit, at)]
                share = np.searchsorted(edges, place - at, "right") - 1
                new = (row[1:] != row[:-1]) | (place[1:] != place[:-1]) | (share[1:] != share[:-1])
                head = np.nonzero(np.append(True, new))[0]
                many = np.diff(np.append(head, len(at)))
                row, at, place, share = row[head], at[head], place[head], share[head]
                end = at + many - 1 + length
                key = mix(hashes.of(place - edges[share], place - edges[share + 1] + 1 + length) + share.astype(np.uint64))
                content = hashes.of(at, end)
                shown = np.zeros(len(at), bool)
                shown[np.unique(content, return_index=True)[1]] = True
                pieces = [together[a:b] if s else None for a, b, s in zip(at, end, shown)]
                start = (at - bounds[row] + first[lo:hi][row]).astype(np.int32)
                own = pa.array(row + lo)
                columns = [batch.column(c).take(own) for c in (0, 1, 2, 5)]
                columns += [_signed(key), _signed(content), pa.array(start), pa.array(many.astype(np.int32)), pa.array(pieces, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return cut


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, tid, text); a NULL id gets a number, so that it can be joined on."""
    text = F.col(text_column).cast("string")
    return docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))).alias("id"),
        F.xxhash64(text).alias("tid"),
        text.alias("text"),
        F.col(id_column).cast("long").alias("own_id"),
    )


def repeated_spans(rows: DataFrame, length: int = LENGTH, keep: str = "none") -> DataFrame:
    """(id, tid, start, end) of bytes of ``rows`` (id, tid, text) that strings of ``length`` bytes cover which occur elsewhere.

    Spans may overlap. With ``keep="first"``, a string's first place, by id, tid
    and start, is no reason to cover it; rows of one id and text count as one then.

    Strings are filed under their anchors (see ``contexts``). A context that
    occurs twice as a whole is covered without more ado. The others under an
    anchor are put in suffix order, where longest-previous-factor arrays tell which
    strings an earlier place has, and the same from behind for later ones.
    Where the contexts of an anchor have over ``TOGETHER`` bytes, they are cut in
    pieces that have more than the anchor in common (see ``_narrowed``) and filed
    anew under that, which parts contexts that go on differently. Pieces that
    occur twice as a whole are covered, the others put in suffix order, and what
    is still too large is cut again, until a piece is one string. A round makes
    a few rows of a context, not one of each string, in combining aggregations
    that no frequent anchor can overload. Anchors, keys and contents are equal if
    two 64-bit hashes are; within suffix order the bytes themselves are compared.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep is none or first")
    if length < 2 * ANCHOR:
        raise ValueError(f"strings need {2 * ANCHOR} bytes or more")
    schema = "id long, tid long, start int, n int, anchor long, content long, repeats boolean"
    found = saved(rows.select("id", "tid", "text").mapInArrow(_contexts_of(length), schema), "contexts")
    shared = found.groupBy("anchor").agg(F.sum(F.when(F.col("repeats"), 2).otherwise(1)).alias("n")).filter("n > 1").select("anchor")
    some = saved(found.join(shared, "anchor", "left_semi"), "shared-contexts")
    remove(found)
    first = F.min(F.struct("id", "tid", "start", "n")).alias("at")
    classes = some.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("seen"), first, F.max("repeats").alias("repeats"))
    classes = saved(classes, "context-classes")
    size = F.col("at.n").cast("long") + (length - 1)
    several = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("m"), F.sum(size).alias("size"), F.max("repeats").alias("any"))
    several = several.filter("m > 1 or any").select("anchor", (F.col("size") <= TOGETHER).alias("fits"))
    open_ = classes.join(several, "anchor")
    wanted = open_.select("at.id", "at.tid", F.struct("anchor", "at.start", "at.n", "seen").alias("one"))
    wanted = wanted.groupBy("id", "tid").agg(F.collect_list("one").alias("wanted"))
    texts = rows.select("id", "tid", "text").join(wanted, ["id", "tid"])
    schema = "id long, tid long, anchor long, start int, n int, seen long, bytes binary"
    pieces = texts.mapInArrow(_snippets(length), schema)
    if keep == "first":
        pieces = pieces.dropDuplicates(["anchor", "id", "tid", "start"])
    pieces = saved(pieces, "snippets").join(several, "anchor")
    kind = "id long, tid long, start int, end int"
    kept = ["id", "tid", "anchor", "start", "n", "seen", "bytes"]
    small, large = pieces.filter("fits").select(*kept), pieces.filter("not fits").select(*kept)
    place = F.struct("id", "tid", "start")
    if keep == "none":
        whole = some.join(classes.filter("seen > 1").select("anchor", "content"), ["anchor", "content"], "left_semi")
    else:
        whole = some.join(classes.filter("seen > 1").select("anchor", "content", "at"), ["anchor", "content"])
        whole = whole.filter(F.struct("at.id", "at.tid", "at.start") < place)
    whole = whole.select("id", "tid", "start", "n")
    schema = "id long, tid long, anchor long, seen long, key long, content long, start int, n int, bytes binary"
    for level in range(1, (length - ANCHOR).bit_length() + 1):
        cut = saved(large.mapInArrow(_narrowed(length, level), schema), "narrowed")
        if cut.isEmpty():
            break
        same = [F.min(c).alias(c) for c in ("anchor", "n")]
        narrow = cut.groupBy("key", "content").agg(F.sum("seen").alias("seen"), F.min(place).alias("at"), F.max("bytes").alias("bytes"), *same)
        narrow = saved(narrow, "narrowed-classes")
        equal = narrow.filter("seen > 1").select("key", "content", "at")
        if keep == "none":
            more = cut.filter("seen = 1").join(equal, ["key", "content"], "left_semi")
        else:
            more = cut.join(equal, ["key", "content"]).filter(F.col("at") < place)
        whole = whole.unionByName(more.select("id", "tid", "start", "n"))
        size = F.col("n").cast("long") + (length - 1)
        several = narrow.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.sum(size).alias("size")).filter("m > 1")
        open_ = narrow.join(several.select("key", (F.col("size") <= TOGETHER).alias("fits")), "key")
        found = ("at.id", "at.tid", "anchor", "at.start", "n", "seen", "bytes")
        small = small.unionByName(open_.filter("fits").drop("anchor").withColumnRenamed("key", "anchor").select(*found))
        large = open_.filter("not fits").select(*found)
    small = small.repartition("anchor").sortWithinPartitions("anchor", "id", "tid", "start")
    by_order = small.mapInArrow(_ordered(length, keep), kind)
    whole = whole.select("id", "tid", "start", (F.col("start") + F.col("n") + (length - 1)).alias("end"))
    return by_order.unionByName(whole)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = batch.column(1).cast(pa.binary()).fill_null(b"").to_pylist(), batch.column(2)
        kept, gone, runs = [], [], []
        for t, listed in zip(texts, spans):
            if not listed.is_valid or not len(listed.values):
                kept.append(t)
                gone.append(0)
                runs.append(0)
                continue
            start, end = (listed.values.field(c).to_numpy() for c in ("start", "end"))
            order = np.argsort(start, kind="stable")
            start, end = start[order], np.maximum.accumulate(end[order])
            new = np.append(True, start[1:] > end[:-1])
            start, end = start[new], end[np.append(new[1:], True)]
            edges = [0, *np.column_stack([start, end]).ravel().tolist(), len(t)]
            kept.append(b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2])))
            gone.append(len(t) - len(kept[-1]))
            runs.append(len(start))
        sizes = pa.array([len(t) for t in texts], pa.int64())
        columns = [batch.column(0), sizes, pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, keep: str = "first"
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) for each row of ``docs``: the bytes of its text that no repeat covers.

    Texts are UTF-8 bytes, a NULL text is empty; matches never cross texts.
    Strings of ``length`` bytes that also start elsewhere, in the same text or
    another, are removed: with ``keep="first"`` all but the first of them by id,
    xxhash64 of the text and start, with ``keep="none"`` every one. Overlapping and
    touching strings are one span; strings are judged on the input, not on what
    is left. A cut may fall inside a code point, so ``kept`` is binary.
    Texts under ``length`` bytes lose nothing. Equal rows are each returned;
    with ``keep="first"`` rows of one id and text lose the same bytes, with
    ``keep="none"`` they are repeats of each other. NULL ids are allowed. Texts are
    worked on in parts of ``PART`` bytes while strings are searched, and cut as a
    whole. Other columns are ignored; an empty table gives no rows. Ids are integers.
    """
    rows = _keyed(docs, id_column, text_column)
    spans = repeated_spans(rows, length, keep)
    spans = spans.groupBy("id", "tid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = rows.join(spans, ["id", "tid"], "left").select("own_id", "text", "spans")
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return joined.mapInArrow(_without, schema).withColumnRenamed("id", id_column)


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), keep="none")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, row_number() OVER () AS k, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT k, i, md5(substr(x, 2 * i + 1, 400)) AS m
  FROM (SELECT k, x, unnest(range(0, greatest(length(x) // 2 - 199, 0))) AS i FROM d)),
r AS (SELECT m FROM w GROUP BY m HAVING count(*) > 1),
c AS (SELECT k, i FROM w SEMI JOIN r ON w.m = r.m),
g AS (SELECT k, i, CASE WHEN i - lag(i) OVER (PARTITION BY k ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM c),
s AS (SELECT k, min(i) AS a, max(i) + 200 AS b
  FROM (SELECT k, i, sum(new) OVER (PARTITION BY k ORDER BY i) AS run FROM g) GROUP BY k, run),
p AS (SELECT k, a, b, coalesce(lag(b) OVER (PARTITION BY k ORDER BY a), 0) AS z FROM s),
t AS (SELECT d.k, string_agg(substr(x, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS y, max(b) AS last,
    sum(b - a) AS gone, count(*) AS n FROM p JOIN d ON d.k = p.k GROUP BY d.k)
SELECT doc_id, length(x) // 2 AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0) AS n_spans,
  sha256(unhex(coalesce(y, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t ON t.k = d.k
"""

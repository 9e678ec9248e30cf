"""Token sequences of bounded length by best-two-fit packing."""

from __future__ import annotations

import base64
import functools
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crmtide.llm.common import hex_bucket, lean, partitions, positions, saved, shuffle_key, table

CAPACITY = 1024
END = 2
# The ranks of byte_bpe_50k.json, whose ids these are; this reader of them is three times as fast.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
# That file lists its added tokens, which stand for themselves wherever a text holds them.
ADDED = public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def encoding(path: str, added: str = ADDED) -> tiktoken.Encoding:
    """The vocabulary whose ranks lie at ``path``, with the added tokens of the tokenizer file ``added``."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
    with open(added, encoding="utf-8") as file:
        special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def _cutter(path: str, capacity: int, with_ids: bool) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_to_numpy
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["id", "piece", "start", "length", "ids_crc32", "ids"]
        for batch in batches:
            rows = []
            for at, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encode(text or "", allowed_special="all"), END).astype("<u4")
                start, end, piece = 0, len(ids) % capacity or capacity, 0
                while start < len(ids):
                    raw = ids[start:end].tobytes()
                    rows.append((at, piece, start, end - start, zlib.crc32(raw), raw if with_ids else None))
                    start, end, piece = end, end + capacity, piece + 1
            arrays = [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 6, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(arrays[0]), *arrays[1:]], names)

    return cut


def cut_pieces(
    docs: DataFrame,
    path: str = VOCABULARY,
    capacity: int = CAPACITY,
    with_ids: bool = True,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, ids) of whole texts; only what exceeds ``capacity`` is cut.

    A text's ids end with id 2; a NULL text is empty and gives that one. Pieces
    after the first are full. ``ids`` are unsigned 32-bit, little-endian. A text is
    encoded whole, however long. Rows with a NULL or repeated id are cut like
    others; other columns are ignored, an empty table gives no rows.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = "id long, piece int, start long, length long, ids_crc32 long, ids binary"
    return rows.mapInArrow(lean(_cutter(path, capacity, with_ids)), schema)


def best_two_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, list[int]]]:
    """(repeats, lengths) of the bins for ``counts[l]`` pieces of each length l up to ``capacity``.

    A bin takes the longest piece that fits its gap, again and again. Then its
    shortest piece makes room for the two unpacked ones that fill the gap it
    leaves best, if those fill it more than it did. Bins of the same make-up are
    made at once, so the work depends on the lengths, not on the pieces.
    """
    left, bins = counts.copy(), []
    while left.any():
        use, gap = [], capacity
        free = left.copy()
        while gap and free[1 : gap + 1].any():
            l = int(np.nonzero(free[: gap + 1])[0][-1])  # noqa: E741
            use.append(l)
            free[l] -= 1
            gap -= l
        if gap and len(use) > 1:
            short = use[-1]
            free[short] += 1
            there = np.nonzero(free[: gap + short])[0]
            other = np.searchsorted(there, gap + short - there, "right") - 1
            twice = (other >= 0) & (there[np.maximum(other, 0)] == there) & (free[there] < 2)
            other = np.where(twice, other - 1, other)
            sums = np.where(other >= 0, there + there[np.maximum(other, 0)], 0) if len(there) else np.zeros(1)
            if sums.max(initial=0) > short:
                best = int(np.argmax(sums))
                use[-1:] = sorted((int(there[best]), int(there[other[best]])), reverse=True)
        kinds, times = np.unique(use, return_counts=True)
        repeats = int((left[kinds] // times).min())
        left[kinds] -= repeats * times
        bins.append((repeats, sorted(use, reverse=True)))
    return bins


class Places:
    """Where the pieces of each length go: the r-th of a length has one slot of one sequence."""

    def __init__(self, bins: list[tuple[int, list[int]]]) -> None:
        used: dict[int, int] = {}
        slots, sequence = [], 0
        for repeats, lengths in bins:
            kinds, times = np.unique(lengths, return_counts=True)
            offset = 0
            for length, k in zip(kinds.tolist(), times.tolist()):
                slots.append((length, used.get(length, 0), k, sequence, offset))
                used[length] = used.get(length, 0) + repeats * k
                offset += length * k
            sequence += repeats
        slots.sort()
        self.slots = np.array(slots, np.int64).reshape(-1, 5)
        self.sequences = sequence

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces by length and rank (from 0) among their length."""
        keys = self.slots[:, 0] << 44 | self.slots[:, 1]
        s = self.slots[np.searchsorted(keys, length << 44 | rank, "right") - 1]
        turn, place = np.divmod(rank - s[:, 1], s[:, 2])
        return s[:, 3] + turn, s[:, 4] + place * length


def _placer(places: Places) -> Callable:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.find(*(batch.column(i).to_numpy() for i in (1, 2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sequence), pa.array(offset)], ["row", "sequence_id", "offset"]
            )

    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; no sequence holds more than ``capacity`` ids.

    Only the number of pieces of each length, ``capacity`` numbers at most, is
    gathered; the bins for them are made once for the whole table, and each
    piece finds its place by its rank among the pieces of its length. Pieces
    that are equal in id and number may change places. Columns of the two names
    are replaced. An empty table gives no rows.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    places = Places(best_two_fit(counts, capacity))
    named = pieces.select(
        "length",
        shuffle_key("pack-1", "id", "piece").alias("_key"),
        F.struct(*[F.col(f"`{c}`") for c in pieces.columns if c not in ("sequence_id", "offset")]).alias("row"),
    ).withColumn("_b", hex_bucket("_key", partitions(pieces.sparkSession)))
    ranked = positions(named, "length", "_b", ["_key"]).select("row", "length", (F.col("_rank") - 1).alias("rank"))
    kind = ranked.schema["row"].dataType.simpleString()
    placed = ranked.mapInArrow(_placer(places), f"row {kind}, sequence_id long, offset long")
    return placed.select("row.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all ``docs``; see ``cut_pieces`` and ``pack``.

    Rows with a NULL or repeated id are packed like others; other columns are ignored.
    """
    pieces = cut_pieces(docs, with_ids=False, id_column=id_column, text_column=text_column).drop("ids")
    return pack(saved(pieces, "pieces")).withColumnRenamed("id", id_column)


def write_sequences(placed: DataFrame, path: str) -> None:
    """Packed pieces in the order of their sequences, a sequence's pieces in one file."""
    placed.repartitionByRange("sequence_id").sortWithinPartitions("sequence_id", "offset").write.parquet(path)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"))

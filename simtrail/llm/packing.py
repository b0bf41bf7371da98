"""Packing of token sequences into windows of fixed capacity by minimum bin slack.

Each document is cut at multiples of the capacity; full windows are sequences of their
own. The remainders of a task go to a buffer by length. For every window the longest
remainder is set, and a subset-sum dynamic programme over the multiset of the other
lengths (a bitset of reachable sums held in one integer, one step per copy group of a
length) finds the choice that comes closest to the capacity; the counts are read back
from the kept bitsets. What a task can't fill at its end is joined, cut at the capacity
and then at powers of two, which need no padding.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from simtrail.llm.bpe import broadcast_vocabulary, worker_encoder
from simtrail.llm.common import slices

# Remainders held per task before windows are made of the older half.
BUFFER = 4096


def closest_subset(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as near to ``room`` as can be, not above it.

    ``counts`` maps a length to how many there are. Stops as soon as the room is filled exactly.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if 0 < x <= room), reverse=True):
        left, size = min(counts[length], room // length), 1
        while left > 0:  # copies in groups of 1, 2, 4, ...: any count is a sum of groups
            take = min(size, left)
            grown = (reach | (reach << (length * take))) & mask
            if grown != reach:
                steps.append((length, take, reach))
                reach = grown
            left -= take
            size *= 2
        if reach >> room:
            break
    target, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not (before >> target) & 1:
            chosen[length] = chosen.get(length, 0) + take
            target -= length * take
    return chosen


class Packer:
    """Holds the remainders of one task and gives whole sequences: lists of (document, start, ids)."""

    def __init__(self, capacity: int):
        self.capacity, self.by_length, self.held = capacity, {}, 0

    def add(self, piece: tuple[int, int, bytes]) -> None:
        self.by_length.setdefault(len(piece[2]) // 4, deque()).append(piece)
        self.held += 1

    def _take(self, length: int) -> tuple[int, int, bytes]:
        rest = self.by_length[length]
        piece = rest.popleft()
        if not rest:
            del self.by_length[length]
        self.held -= 1
        return piece

    def window(self) -> list[tuple[int, int, bytes]]:
        longest = max(self.by_length)
        out = [self._take(longest)]
        counts = {k: len(v) for k, v in self.by_length.items()}
        for length, n in closest_subset(counts, self.capacity - longest).items():
            out += [self._take(length) for _ in range(n)]
        return out

    def filled(self, down_to: int) -> Iterator[tuple[bool, list[tuple[int, int, bytes]]]]:
        """Windows until ``down_to`` remainders are held, and whether each is full."""
        while self.held > down_to:
            got = self.window()
            yield sum(len(p[2]) for p in got) == 4 * self.capacity, got


def cut_without_padding(pieces: list[tuple[int, int, bytes]], capacity: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Join pieces and cut them to full windows, then to falling powers of two."""
    left = sum(len(p[2]) // 4 for p in pieces)
    queue = deque(pieces)
    while left:
        size = capacity if left >= capacity else 1 << (left.bit_length() - 1)
        room, out = size, []
        while room:
            key, start, ids = queue.popleft()
            n = min(room, len(ids) // 4)
            out.append((key, start, ids[: 4 * n]))
            if 4 * n < len(ids):
                queue.appendleft((key, start + n, ids[4 * n :]))
            room -= n
        left -= size
        yield out


def pack(
    df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 1
) -> DataFrame:
    """Pack the encoded texts (each followed by ``end_id``) into sequences of at most ``capacity`` tokens.

    One row per piece: the id column, ``start`` (ids of that text before the piece), ``length``, ``ids``
    (packed little-endian uint32), ``doc_tokens`` (with the end id), ``sequence_id``, ``offset`` (place in the
    sequence, without gaps from 0). Null and empty texts are packed as their end id alone; repeated rows
    and null ids are packed each for itself; very long texts give full windows one after another. Every
    sequence is full or a power of two long, so none needs padding. Each task packs its own rows (no
    shuffle) and holds at most ``BUFFER`` remainders; sequence ids are (partition, number) and come out
    alike when a task runs again.
    """
    vocabulary = broadcast_vocabulary(df, tokenizer_path)
    id_type = df.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, id_type),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_encoder(vocabulary)
        packer, rows, sequence = Packer(capacity), [], TaskContext.get().partitionId() << 33
        open_bins: list[tuple] = []

        def put(pieces) -> None:
            nonlocal sequence
            offset = 0
            for (key, total), start, ids in pieces:
                rows.append((key, start, len(ids) // 4, ids, total, sequence, offset))
                offset += len(ids) // 4
            sequence += 1

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)
            rows.clear()
            return out

        for batch in slices(batches):
            texts = coder.encode(batch.column(text_col).to_pylist())
            for key, ids in zip(batch.column(id_col).to_pylist(), texts, strict=True):
                ids += end
                total = len(ids) // 4
                whole = total - total % capacity
                for at in range(0, whole, capacity):
                    put([((key, total), at, ids[4 * at : 4 * (at + capacity)])])
                    if len(rows) >= 2048:
                        yield flush()
                if whole < total:
                    packer.add(((key, total), whole, ids[4 * whole :]))
            if packer.held >= BUFFER:
                for full, pieces in packer.filled(BUFFER // 2):
                    put(pieces) if full else open_bins.extend(pieces)
                if len(open_bins) >= BUFFER:  # lengths that never fill a window: join and cut what there is
                    for pieces in cut_without_padding(open_bins, capacity):
                        put(pieces)
                    open_bins.clear()
            if rows:
                yield flush()
        coder.memory = type(coder.memory)()  # the worker may go on with other work
        for full, pieces in packer.filled(0):
            put(pieces) if full else open_bins.extend(pieces)
            if len(rows) >= 2048:
                yield flush()
        for pieces in cut_without_padding(open_bins, capacity):
            put(pieces)
        if rows:
            yield flush()

    return df.select(id_col, text_col).mapInArrow(run, schema)

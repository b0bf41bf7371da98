"""Phrase collocations from sorted streams of n-gram counts.

Every word position gives one key: language, the word, and up to two more words of its piece, so the
counts of words and pairs are sums over neighbouring keys of one sorted stream and are never counted
on their own. Tasks count their keys in sorted runs; the runs are cut at common range borders, sorted
by Spark (which spills) and summed in one pass over each range. Only a group that touches a border of
its range can be incomplete there; those few are added up afterwards.

The phrases found often enough then lie in two streams: prefix order (the key as it is) and suffix
order (its words turned round). One pass over either keeps the last word and the last pair read: they
are the headers of what follows, so the prefix pass meets every phrase with the counts of its first
parts, the suffix pass with those of its last parts, and both see the strongest extension of a pair.
A last pass merges the two results in prefix order. No look-up by hash takes part: what a range needs
of an earlier one are the headers of its first key, at most two a range.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simtrail.llm.common import slices, utf8_bytes
from simtrail.session import drop_staged, stage

# Words of one sorted run, and bytes of a text turned to words at once.
RUN, SPAN = 1 << 20, 1 << 21
# Texts, keys a text and keys a range that range borders are taken from; they move work, never results.
SAMPLE_TEXTS, SAMPLE_KEYS, KEYS_A_RANGE = 4000, 48, 64
ROWS = 1 << 15
# A-Z lower-cased, tabs to blanks, all that ends a piece to one mark.
MARK = b"."
_FOLD = bytearray(range(256))
_FOLD[ord("A") : ord("Z") + 1] = b"abcdefghijklmnopqrstuvwxyz"
_FOLD[ord("\t")] = ord(" ")
for _end in b".,;:!?\n\x0b\x0c\r":
    _FOLD[_end] = ord(MARK)
_FOLD = bytes(_FOLD)

KEYS = "range int, gram binary, n long"
COUNTS = "level int, gram binary, n long, whole boolean"
PARTS = "gram binary, f long, one long, two long, longer long, suffix boolean"
FOUND = "lang string, phrase string, a long, l long, r long, score long"


def words_of(raw: bytes) -> Iterator[list[bytes]]:
    """Words of a text with a mark between pieces, in lists of bounded size."""
    at = 0
    while at < len(raw):
        to = len(raw) if at + SPAN >= len(raw) else _blank(raw, at + SPAN)
        # after the fold a blank is the only white space left
        yield raw[at:to].translate(_FOLD).replace(MARK, b" . ").split()
        at = to


def _blank(raw: bytes, at: int) -> int:
    """Place of the next blank or tab, where a text can be cut between words."""
    found = [p for p in (raw.find(b" ", at), raw.find(b"\t", at)) if p >= 0]
    return min(found) if found else len(raw)


class Borders:
    """Sorted first keys of all ranges but the first; keys are compared as bytes, which is word by word as each word
    ends in a blank and holds none."""

    def __init__(self, keys: list[bytes]):
        self.keys = keys

    def range_of(self, gram: bytes) -> int:
        return bisect.bisect_right(self.keys, gram)

    def cut(self, lang: bytes, padded: list[bytes], base: int) -> tuple[int, np.ndarray]:
        """Borders before all keys of ``lang``, and those among them as numbers in ``base`` (0: no word, i + 1: the i-th
        of the sorted ``padded`` words)."""
        first = bisect.bisect_left(self.keys, lang)
        inside = []
        for key in self.keys[first:]:
            if not key.startswith(lang):
                break
            places = []
            for word in key[len(lang) :].split(b" ")[:-1]:
                at = bisect.bisect_left(padded, word + b" ")
                places.append(at + 1)
                if at == len(padded) or padded[at] != word + b" ":
                    break  # every key from the next word on lies behind the border
            a, b, c = (places + [0, 0, 0])[:3]
            inside.append((a * base + b) * base + c)
        return first, np.array(inside, np.int64)


def _run(lang: bytes, words: list[bytes], starts: int, borders: Borders) -> Iterator[pa.RecordBatch]:
    """Counts of the keys that start at the first ``starts`` words, sorted; ``lang`` ends in a blank."""
    coded = pa.array(words, pa.binary()).dictionary_encode()
    padded = pc.binary_join_element_wise(coded.dictionary, b"", b" ")
    mark = coded.dictionary.index(pa.scalar(MARK, pa.binary())).as_py()
    order = pc.array_sort_indices(padded).to_numpy()
    order = order[order != mark]
    rank = np.zeros(len(padded), np.int64)  # the mark keeps 0: no word
    rank[order] = np.arange(1, len(order) + 1)
    t = np.concatenate([rank[coded.indices.to_numpy()], [0, 0]])
    a, b, c = t[:starts], t[1 : starts + 1], t[2 : starts + 2]
    base = len(order) + 1  # below 2^21: a run and a span hold fewer different words
    keys = ((a * base + b) * base + np.where(b == 0, 0, c))[a != 0]
    if not keys.size:
        return
    keys, n = np.unique(keys, return_counts=True)
    sorted_words = padded.take(pa.array(order))
    first, inside = borders.cut(lang, sorted_words.to_pylist() if borders.keys else [], base)
    ranges = (first + np.searchsorted(inside, keys, side="right")).astype(np.int32)
    part = pa.concat_arrays([pa.array([b""], pa.binary()), sorted_words])
    for at in range(0, len(keys), ROWS):
        some = keys[at : at + ROWS]
        pieces = [part.take(pa.array(x)) for x in (some // (base * base), some // base % base, some % base)]
        gram = pc.binary_join_element_wise(pa.scalar(lang, pa.binary()), *pieces, b"")
        yield pa.RecordBatch.from_arrays(
            [pa.array(ranges[at : at + ROWS]), gram, pa.array(n[at : at + ROWS])], names=["range", "gram", "n"]
        )


def _runs(texts: DataFrame, borders: Borders, size: int) -> DataFrame:
    """(range, gram, n) of texts (lang, text): each task's keys, counted in runs of ``size`` words."""
    sent = texts.sparkSession.sparkContext.broadcast(borders)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[bytes]] = {}
        fresh = 0
        for batch in slices(batches):
            langs = batch.column("lang").to_pylist()
            for lang, raw in zip(langs, utf8_bytes(batch.column("text")), strict=True):
                words = held.setdefault(quote(lang, safe="").encode() + b" ", [])
                for some in words_of(raw):
                    words += some
                    fresh += len(some)
                    if fresh >= size:
                        for name, known in held.items():
                            # the last two words wait for what follows them
                            yield from _run(name, known, max(len(known) - 2, 0), sent.value)
                            del known[:-2]
                        fresh = 0
                words.append(MARK)
                fresh += 1
        for name, known in held.items():
            yield from _run(name, known, len(known), sent.value)

    return texts.mapInArrow(run, KEYS)


def _text_borders(texts: DataFrame, ranges: int) -> Borders:
    """Range borders from keys at random places of a bounded sample of texts."""
    n = texts.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(5)
        for batch in slices(batches):
            found = set()
            for lang, raw in zip(batch.column("lang").to_pylist(), utf8_bytes(batch.column("text")), strict=True):
                at = int(rng.integers(0, max(len(raw) - SPAN, 0) + 1))
                words = next(words_of(raw[at : at + SPAN]), [])
                for p in rng.integers(0, max(len(words), 1), SAMPLE_KEYS):
                    some = words[p : p + 3]
                    some = some[: some.index(MARK)] if MARK in some else some
                    if some:
                        found.add(b" ".join([quote(lang, safe="").encode(), *some, b""]))
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.binary())], names=["gram"])

    share = min(1.0, SAMPLE_TEXTS / max(n, 1))
    some = texts.where(F.rand(7) < share).limit(2 * SAMPLE_TEXTS)
    return _borders([bytes(r[0]) for r in some.mapInArrow(run, "gram binary").collect()], ranges)


def _borders(keys: list[bytes], ranges: int) -> Borders:
    keys = sorted(set(keys))
    return Borders(sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)} if keys else ()))


def _prefix_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all blanks, the number of the first one of every row, and how many each row has."""
    blanks = np.flatnonzero(data[: offsets[-1]] == ord(" "))
    first = np.searchsorted(blanks, offsets[:-1])
    return blanks, first, np.searchsorted(blanks, offsets[1:]) - first


def _changes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether a row's bytes differ from those of the row before (the first always does)."""
    differs = np.ones(len(start), bool)
    rows = np.flatnonzero(length[1:] == length[:-1]) + 1
    if rows.size:
        size = length[rows]
        ends = np.cumsum(size)
        within = np.arange(ends[-1]) - np.repeat(ends - size, size)
        equal = data[np.repeat(start[rows], size) + within] == data[np.repeat(start[rows - 1], size) + within]
        differs[rows] = ~np.logical_and.reduceat(equal, ends - size)
    return differs


class _Level:
    """Running sum over the keys of a sorted range that share their language and first ``level`` words."""

    def __init__(self, level: int, least: int):
        self.level, self.least = level, least if level else 0
        self.open: list | None = None  # prefix, sum, whether it is the first of its range

    def _done(self, last: bool) -> list[tuple]:
        prefix, n, first = self.open
        self.open = None
        whole = self.level == 3 or not (first or last)  # a whole key lies in one range
        return [(self.level, prefix, n, whole)] if n >= self.least or not whole else []

    def read(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, n: np.ndarray, fresh: bool) -> list[tuple]:
        """Groups that are over; the last one stays open."""
        if not start.size:
            return []
        at = np.flatnonzero(_changes(data, start, end - start))
        sums = np.add.reduceat(n, at)
        name = lambda g: data[start[at[g]] : end[at[g]]].tobytes()
        out, first = [], self.open is None and fresh
        if self.open is not None:
            if self.open[0] == name(0):
                sums[0] += self.open[1]
                first = self.open[2]
            else:
                out += self._done(False)
        if len(at) > 1:
            self.open = [name(0), int(sums[0]), first]
            out += self._done(False)
            first = False
        out += [(self.level, name(g), int(sums[g]), True) for g in np.flatnonzero(sums[1:-1] >= self.least) + 1]
        self.open = [name(len(at) - 1), int(sums[-1]), first]
        return out

    def close(self) -> list[tuple]:
        return self._done(True) if self.open is not None else []


def _sum_ranges(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, now, fresh = [_Level(i, least) for i in range(4)], None, [True] * 4
        for batch in batches:
            ranges, n = batch.column("range").to_numpy(), batch.column("n").to_numpy()
            column = batch.column("gram")
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1].astype(np.int64)
            data = np.frombuffer(column.buffers()[2], np.uint8)
            blanks, first, many = _prefix_ends(data, offsets)
            rows = []
            bounds = [0, *(np.flatnonzero(np.diff(ranges)) + 1), len(ranges)]
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                if lo < hi and ranges[lo] != now:
                    rows += [r for level in levels for r in level.close()]
                    now, fresh = ranges[lo], [True] * 4
                for i, level in enumerate(levels):
                    some = np.arange(lo, hi)[many[lo:hi] > i]
                    rows += level.read(data, offsets[some], blanks[first[some] + i] + 1, n[some], fresh[i])
                    fresh[i] = fresh[i] and not some.size
            yield _rows(rows)
        yield _rows([r for level in levels for r in level.close()])

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    level, gram, n, whole = zip(*rows, strict=True) if rows else ((), (), (), ())
    arrays = [pa.array(level, pa.int32()), pa.array(gram, pa.binary()), pa.array(n, pa.int64()), pa.array(whole, pa.bool_())]
    return pa.RecordBatch.from_arrays(arrays, names=["level", "gram", "n", "whole"])


def gram_counts(texts: DataFrame, least: int, run: int = RUN) -> DataFrame:
    """Staged (level, gram, n): all n-grams of 1 to 3 words of (lang, text) that occur ``least`` times, and, as level 0,
    the number of all words per language. A gram is the quoted language and its words, a blank after each."""
    ranges = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = _runs(texts, _text_borders(texts, ranges), run)
    ordered = runs.repartitionById(ranges, F.col("range")).sortWithinPartitions("gram")
    summed = stage(ordered.mapInArrow(_sum_ranges(least), COUNTS), "collocation-sums")
    parts = summed.where("not whole").groupBy("level", "gram").agg(F.sum("n").alias("n"))
    complete = summed.where("whole").select("level", "gram", "n").union(parts)
    counts = stage(complete.where((F.col("level") == 0) | (F.col("n") >= least)), "collocation-counts")
    drop_staged(summed)
    return counts


def _turned(gram: bytes) -> bytes:
    """The gram with its words turned round."""
    lang, *words = gram.split(b" ")[:-1]
    return b" ".join([lang, *words[::-1], b""])


def _headers(gram: bytes) -> list[bytes]:
    """The gram's first word and first two words, as grams."""
    words = gram.split(b" ")
    return [b" ".join(words[:k]) + b" " for k in (2, 3) if k < len(words)]


def _dealt(rows: DataFrame, borders: Borders) -> DataFrame:
    """Rows (gram, ...) by range, sorted by gram within it."""
    sent = rows.sparkSession.sparkContext.broadcast(borders)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [sent.value.range_of(g) for g in batch.column("gram").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *batch.columns], names=["range", *batch.schema.names])

    schema = "range int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    dealt = rows.mapInArrow(run, schema).repartitionById(len(borders.keys) + 1, F.col("range"))
    return dealt.sortWithinPartitions("gram").drop("range")


def _stream(counts: DataFrame, suffix: bool) -> DataFrame:
    """(gram, f) of levels 1 to 3 in prefix order, or with the words turned round."""
    rows = counts.where("level > 0").select("gram", F.col("n").alias("f"))
    if not suffix:
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turned = [_turned(g) for g in batch.column("gram").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(turned, pa.binary()), batch.column("f")], names=["gram", "f"])

    return rows.mapInArrow(run, "gram binary, f long")


def _stream_borders(stream: DataFrame, ranges: int) -> Borders:
    n = stream.count()
    share = min(1.0, KEYS_A_RANGE * ranges / max(n, 1))
    some = stream.where(F.rand(11) < share).limit(2 * KEYS_A_RANGE * ranges)
    return _borders([bytes(r[0]) for r in some.select("gram").collect()], ranges)


def _with_headers(stream: DataFrame, borders: Borders, suffix: bool) -> DataFrame:
    """Every phrase with the counts of its first word and first pair in stream order, and for pairs a row a range with
    the strongest phrase of three words behind them; grams in prefix order again."""
    wanted = sorted({h for key in borders.keys for h in _headers(key)})
    spark = stream.sparkSession
    # at most two headers a range
    listed = F.broadcast(spark.createDataFrame([(w,) for w in wanted], "gram binary"))
    given = spark.sparkContext.broadcast({bytes(r.gram): r.f for r in stream.join(listed, "gram").collect()} if wanted else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, best = [(b"", 0), (b"", 0)], (b"", 0)
        back = _turned if suffix else bytes
        for batch in batches:
            rows = []
            for gram, f in zip(batch.column("gram").to_pylist(), batch.column("f").to_pylist(), strict=True):
                known = []
                for i, name in enumerate(_headers(gram)):
                    if name != gram and head[i][0] != name:
                        head[i] = name, given.value[name]  # begun in an earlier range
                    elif name == gram:
                        head[i] = gram, f
                    if name != gram:
                        known.append(head[i][1])
                if not known:
                    continue
                if len(known) == 2:
                    if best[0] != head[1][0]:
                        if best[1]:
                            rows.append((back(best[0]), None, None, None, best[1], suffix))
                        best = head[1][0], 0
                    best = best[0], max(best[1], f)
                rows.append((back(gram), f, known[0], known[1] if len(known) == 2 else None, None, suffix))
            yield _parts(rows)
        yield _parts([(back(best[0]), None, None, None, best[1], suffix)] if best[1] else [])

    return _dealt(stream, borders).mapInArrow(run, PARTS)


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * 6
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["gram", "f", "one", "two", "longer", "suffix"]
    )


def _scored(percent: int):
    """Merge of both passes, sorted by gram: candidates that are not part of a longer one nearly as frequent."""

    def verdict(gram: bytes, f: int, left: list, right: list, longer: int) -> list[tuple]:
        if longer and 100 * longer >= percent * f:
            return []
        lang, *words = gram.split(b" ")[:-1]
        cuts = [(left[0], right[0])] if len(words) == 2 else [(left[0], right[1]), (left[1], right[0])]
        score, _, l, r = min((1_000_000 * f * f // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
        return [(lang.decode(), b" ".join(words).decode(), f, l, r, score)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, f, sides, longer = None, 0, {}, 0
        for batch in batches:
            rows = []
            for gram, n, one, two, more, suffix in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if gram != now:
                    if now is not None:
                        rows += verdict(now, f, sides[False], sides[True], longer)
                    now, f, sides, longer = gram, 0, {}, 0
                if more is None:
                    f, sides[suffix] = n, (one, two)
                else:
                    longer = max(longer, more)
            yield _found(rows)
        if now is not None:
            yield _found(verdict(now, f, sides[False], sides[True], longer))

    return run


def _found(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * 6
    kinds = [pa.string(), pa.string(), *[pa.int64()] * 4]
    names = ["lang", "phrase", "a", "l", "r", "score"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, top: int = 2000, percent: int = 50,
    run: int = RUN,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two and three words of each language.

    A-Z are lower-cased, texts cut at ``[.,;:!?]`` and line ends into pieces, those at blanks and tabs into words.
    ``a`` counts all places of the phrase, ``n`` all words of the language; a cut of the phrase has the counts ``l`` and
    ``r`` of its parts and the score floor(1000000 * a * a / (l * r)), in whole numbers of any size; the lowest cut
    counts (of equal ones the first). Phrases with fewer than ``least`` places are left out, as are pairs inside a
    phrase of three with ``percent`` % of their places or more. Order: score, then a (both falling), then the phrase in
    UTF-8 byte order.

    A null language is 'und', a null text empty; repeated rows count each time; whole texts of any length are read.
    Other columns are not read, whatever their names; an empty table gives an empty one. ``run`` bounds the words a task
    holds at once and changes no result.
    """
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = gram_counts(texts, least, run)
    forward, backward = _stream(counts, False), _stream(counts, True)
    borders = _stream_borders(forward, ranges)
    passes = _with_headers(forward, borders, False).union(
        _with_headers(backward, _stream_borders(backward, ranges), True)
    )
    # the passes meet in prefix order; ranges are again those of the prefix stream
    found = _dealt(passes, borders).mapInArrow(_scored(percent), FOUND)
    # best of each language in two steps, so that the last task of a language sees no more than the root of all ranges' bests
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(math.isqrt(ranges) + 1)))
    some = Window.partitionBy("lang", "_salt").orderBy(*order)
    best = salted.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top).drop("_salt")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    best = best.where(F.col("rank") <= top)
    n = counts.where("level = 0").select(F.trim(F.col("gram").cast("string")).alias("lang"), "n")
    return best.join(n, "lang").select(F.url_decode("lang").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")

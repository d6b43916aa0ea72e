"""Suffix-array deduplication: remove every byte in a long string that occurs elsewhere.

Suffixes that agree on ``LENGTH`` bytes must meet in one task.  Their first LENGTH bytes choose the
task: the window's anchor is its least GRAM-byte hash, so equal windows have equal anchors, and a run
of windows with one anchor is a context.  Equal contexts are added up to one with a weight before
anything is sorted.  Each context whose anchor recurs is cut at fixed distances from the anchor into
pieces with a core; pieces with equal cores are sorted together as suffixes of their core-compressed
bytes.  The sort has two stages: suffixes smaller than their successor are sorted directly, the
others are induced by scanning buckets; runs of adjacent suffixes with a common prefix of LENGTH bytes
are repeats if their weights add up to two.  A core with too many different pieces for one task is
made longer, which halves the windows of a piece, until its groups fit or a piece is one window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Mapped, WorkerScratch, binary_array, rolling_hashes, row_key, skew_safe_join, text_bytes, text_slices

LENGTH = 400
GRAM = 128
#: Distances from the anchor that share a core at first; the core is LENGTH + 1 - STEP bytes.  A power of two.
STEP = 64
#: Different pieces that one group may hold in a task.
GROUP = 4096
#: Bytes that are sorted as one suffix array, or one group; and those of all arrays of a task.
SORT_BYTES = 1 << 20
TASK_BYTES = 2 << 20
_BLOCK = 1 << 20


def anchor_runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(document, anchor, low, high, hash) of every context, positions within the document.

    A window's anchor is the place of its least gram hash, the leftmost of equal ones; windows
    low..high have the same anchor.
    """
    lens = np.diff(offsets)
    empty = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    if not len(data) or lens.max() < length:
        return empty
    place_bits = np.uint64(20)
    out = []
    width = length - gram + 1
    doc_of = np.repeat(np.arange(len(lens)), lens)
    fits = np.repeat(offsets[1:] - length, lens)  # the last window's start
    for base in range(0, len(data) - length + 1, _BLOCK - length + 1):
        part = data[base : base + _BLOCK]
        hashes = rolling_hashes(part, gram)
        key = (hashes >> place_bits << place_bits) | np.arange(len(hashes), dtype=np.uint64)
        least, span = key, 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = width - span
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        windows = len(part) - length + 1
        anchor = (least[:windows] & np.uint64((1 << 20) - 1)).astype(np.int64)
        start = np.arange(windows) + base
        doc = doc_of[base : base + windows]
        inside = start <= fits[base : base + windows]
        change = np.ones(windows, bool)
        change[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(change & inside)
        # Within a document the windows that fit come first, so a run ends before the next run or the last fit.
        ends = np.flatnonzero(np.append(change[1:] | ~inside[1:], True) & inside)
        out.append((doc[first], anchor[first] + base - offsets[doc[first]], start[first] - offsets[doc[first]], start[ends] - offsets[doc[first]], hashes[anchor[first]]))
    if not out:
        return empty
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _anchor_rows() -> Mapped:
    """(__key, anchor, context, at, low, high): one row per context of every document (__key, __text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch, data, offsets in text_slices(batches, "__text", 2 << 20):
                doc, at, low, high, hashes = anchor_runs(data, offsets)
                if not len(doc):
                    continue
                raw, base = data.tobytes(), offsets[doc]
                view = memoryview(raw)
                digests = b"".join(
                    hashlib.blake2b(view[a:b], digest_size=16, salt=int(d).to_bytes(8, "little")).digest()
                    for a, b, d in zip((base + low).tolist(), (base + high + LENGTH).tolist(), (at - low).tolist(), strict=True)
                )
                keys = batch.column(0).take(pa.array(doc))
                columns = [keys, pa.array(hashes.view(np.int64)), binary_array(np.frombuffer(digests, np.uint8).reshape(-1, 16), 16), pa.array(at.astype(np.int32)), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["__key", "anchor", "context", "at", "low", "high"])

    return run, "__key binary, anchor long, context binary, at int, low int, high int"


def two_stage_suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """The suffix array of a byte array; with ``depth``, sorted on that many bytes at least.

    Stage one sorts the suffixes smaller than their successor, by successive 7-byte words.  Stage
    two scans the buckets of first bytes upwards: a suffix larger than its successor follows from
    the place of that successor, and enters its bucket in the order in which successors are met.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    t = text.astype(np.int16)
    # Smaller than the successor: the next different byte is larger; the last suffix is larger than the empty one.
    change = np.flatnonzero(t[1:] != t[:-1])
    rising = np.zeros(n, bool)
    if len(change):
        up = t[change + 1] > t[change]
        which = np.searchsorted(change, np.arange(n))
        rising[:] = np.append(up, False)[np.minimum(which, len(change))]
    ordered = _sort_directly(text, np.flatnonzero(rising), n if depth is None else depth)
    bounds = np.searchsorted(text[ordered], np.arange(257))
    buckets: list[list[np.ndarray]] = [[] for _ in range(256)]
    buckets[int(text[n - 1])].append(np.array([n - 1]))  # its successor, the empty suffix, comes before all
    out = []
    for c in range(256):
        falling = buckets[c]
        k = 0
        while k < len(falling):  # grows while runs of one byte induce themselves
            out.append(falling[k])
            _induce(falling[k], t, rising, buckets)
            k += 1
        own = ordered[bounds[c] : bounds[c + 1]]
        if len(own):
            out.append(own)
            _induce(own, t, rising, buckets)
    return np.concatenate(out)


def _induce(placed: np.ndarray, t: np.ndarray, rising: np.ndarray, buckets: list[list[np.ndarray]]) -> None:
    before = placed[placed > 0] - 1
    before = before[~rising[before]]
    if not len(before):
        return
    first = t[before]
    order = np.argsort(first, kind="stable")
    before, first = before[order], first[order]
    cut = np.flatnonzero(first[1:] != first[:-1]) + 1
    for part in np.split(before, cut):
        buckets[int(t[part[0]])].append(part)


def _sort_directly(text: np.ndarray, places: np.ndarray, most: int) -> np.ndarray:
    """Sort suffixes by 7-byte words; only those still tied, up to ``most`` bytes, look at their next word."""
    n = len(text)
    if not len(places):
        return places
    padded = np.zeros(n + 16, np.uint64)
    padded[:n] = text.astype(np.uint64) + np.uint64(1)  # 0 is the end of the text
    word = np.zeros(n + 8, np.uint64)
    for k in range(7):
        word = (word << np.uint64(9)) | padded[k : k + n + 8]
    order = places[np.argsort(word[places], kind="stable")]
    keys = word[order]
    depth = 7
    slots = np.arange(len(order))
    new = np.append(True, keys[1:] != keys[:-1])
    while True:
        group = np.cumsum(new) - 1
        tied = np.bincount(group)[group] > 1
        if depth >= most or not tied.any():
            return order
        slots, group = slots[tied], group[tied]
        own = order[slots]
        keys = word[np.minimum(own + depth, n)]
        by = np.lexsort((keys, group))
        order[slots], keys, group = own[by], keys[by], group[by]
        new = np.append(True, (keys[1:] != keys[:-1]) | (group[1:] != group[:-1]))
        depth += 7


def common_prefix_runs(text: np.ndarray, order: np.ndarray, places: np.ndarray, length: int, weight: np.ndarray | None = None) -> np.ndarray:
    """For each of ``places`` whether it shares ``length`` bytes with another, or has a weight above 1 itself.

    Adjacent suffixes are compared over ``length`` bytes; those between two cuts are one run, in
    which only ``places`` count, each as often as its weight says.
    """
    n = len(text)
    which = np.full(n, -1)
    which[places] = np.arange(len(places))
    which = which[order]
    which = which[which >= 0]  # suffixes between two of a run share as much, so they can be left out
    own = places[which]
    if not len(own):
        return np.zeros(0, bool)
    same = np.ones(len(own) - 1, bool)
    a, b = own[:-1], own[1:]
    for k in range(0, length, 8):
        live = np.flatnonzero(same)
        if not len(live):
            break
        step = np.arange(k, min(length, k + 8))
        x, y = a[live, None] + step, b[live, None] + step
        same[live] = ((x < n) & (y < n) & (text[np.minimum(x, n - 1)] == text[np.minimum(y, n - 1)])).all(1)
    run = np.concatenate([[0], np.cumsum(~same)])
    hit = np.zeros(len(places), bool)
    hit[which] = np.bincount(run, None if weight is None else weight[which])[run] > 1
    return hit


_DONE = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _merge(low: np.ndarray, high: np.ndarray, length: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes that windows low..high cover, as (start, end)."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, low, 1)
    np.add.at(delta, np.minimum(high + length, n), -1)
    covered = np.concatenate([[False], np.cumsum(delta[:n]) > 0, [False]])
    edge = np.diff(covered.astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _finish(raw: bytes, low: np.ndarray, high: np.ndarray) -> tuple[int, int, int, str]:
    starts, ends = _merge(low, high, LENGTH, len(raw))
    digest, at = hashlib.sha256(), 0
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        digest.update(raw[at:a])
        at = b
    digest.update(raw[at:])
    return len(raw), int((ends - starts).sum()), len(starts), digest.hexdigest()


_PIECES = "core binary, piece binary, left binary, right binary, anchor long, context binary, far int, n long"


def _pieces(raw: bytes, at: int, low: int, high: int) -> Iterator[tuple[bytes, bytes, bytes, int]]:
    """Cut a context by distance from the anchor: (core, left, right, distance of the first window)."""
    core = LENGTH + 1 - STEP
    for j in range((at - high) // STEP, (at - low) // STEP + 1):
        far, near = min(at - low, j * STEP + STEP - 1), max(at - high, j * STEP)
        a = at - j * STEP  # start of the core
        digest = hashlib.blake2b(raw[a : a + core], digest_size=16, salt=j.to_bytes(8, "little")).digest()
        yield digest, raw[at - far : a], raw[a + core : at - near + LENGTH], far


def _halves(core: bytes, left: bytes, right: bytes, far: int, step: int) -> Iterator[tuple[bytes, bytes, bytes, int]]:
    """A piece of ``step`` distances as two of half as many, whose cores are longer by half a step.

    A window takes so many bytes of ``left`` and step - 1 less so many of ``right``: those that take at
    least half a step of the left side share that much there, the others share it on the right.
    """
    half = step // 2
    if len(left) >= half:
        yield hashlib.blake2b(left[-half:], digest_size=16, key=core, salt=b"left").digest(), left[:-half], right[: half - 1], far
    if len(right) >= half:
        near = min(len(left), half - 1)
        yield hashlib.blake2b(right[:half], digest_size=16, key=core, salt=b"right").digest(), left[len(left) - near :], right[half:], far - (len(left) - near)


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    """With ``piece``, a digest of core and both sides."""
    types = [pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
    core, left, right, anchor, context, far, n = (pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))
    piece = [hashlib.blake2b(b + c, digest_size=16, key=a, salt=len(b).to_bytes(4, "little")).digest() for a, b, c, *_ in rows]
    return pa.RecordBatch.from_arrays([core, pa.array(piece, pa.binary()), left, right, anchor, context, far, n], ["core", "piece", "left", "right", "anchor", "context", "far", "n"])


def _cut() -> Mapped:
    """The pieces of contexts: rows are __text and __marks, [(anchor, context, at, low, high, n)]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            out: list[tuple] = []
            for i, marks in enumerate(batch.column(1)):
                raw = data[offsets[i] : offsets[i + 1]].tobytes()
                for m in marks.as_py():
                    out += [(core, left, right, m["anchor"], m["context"], far, m["n"]) for core, left, right, far in _pieces(raw, m["at"], m["low"], m["high"])]
                    if len(out) >= 5000:
                        yield _piece_batch(out)
                        out = []
            if out:
                yield _piece_batch(out)

    return run, _PIECES


def _halved(step: int) -> Mapped:
    """Both halves of pieces (core, left, right, anchor, context, far, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for core, left, right, anchor, context, far, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                out += [(*own[:3], anchor, context, own[3], n) for own in _halves(core, left, right, far, step)]
            if out:
                yield _piece_batch(out)

    return run, _PIECES


def _sorted_windows(pieces: DataFrame, step: int, tasks: int) -> DataFrame:
    """(piece, owners, first, last): runs of windows that repeat, of the different pieces (core, piece, left, right, n, owners)."""
    tail = step - 1 + len(_core_mark(0))  # bytes of a window with its core written short

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, group, last = 0, -1, None
        for batch in batches:
            for core, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if core != last:
                    if size >= SORT_BYTES:  # groups stay whole
                        yield from _repeats(held, tail)
                        held, size, group = [], 0, -1
                    group, last = group + 1, core
                held.append((*row, _core_mark(group)))
                size += len(row[1]) + len(row[2]) + 8
        if held:
            yield from _repeats(held, tail)

    rows = pieces.select("core", "piece", "left", "right", "n", "owners").repartition(tasks, "core").sortWithinPartitions("core")
    return rows.mapInArrow(run, "piece binary, owners long, first int, last int")


def _core_mark(group: int) -> bytes:
    """Eight bytes that UTF-8 never holds, so that cores match cores only."""
    return bytes(0xF8 | (group >> s) & 7 for s in range(21, -1, -3))


def _repeats(held: list[tuple], tail: int) -> Iterator[pa.RecordBatch]:
    """Sort the suffixes of (piece, left, right, n, owners, mark) rows and give the runs of windows that repeat."""
    text = np.frombuffer(b"".join(left + mark + right for _, left, right, _, _, mark in held), np.uint8)
    size = np.array([len(left) + len(right) + len(mark) for _, left, right, _, _, mark in held])
    start = np.cumsum(size) - size
    windows = size - tail + 1
    piece = np.repeat(np.arange(len(held)), windows)
    offset = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
    weight = np.array([min(row[3], 2) for row in held])
    hit = common_prefix_runs(text, two_stage_suffix_array(text, tail), start[piece] + offset, tail, weight[piece])
    if not hit.any():
        return
    piece, offset = piece[hit], offset[hit]
    # Neighbouring windows of a piece become one row.
    first = np.flatnonzero(np.append(True, (piece[1:] != piece[:-1]) | (offset[1:] != offset[:-1] + 1)))
    last = np.append(first[1:], len(piece)) - 1
    own = [held[i] for i in piece[first].tolist()]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in own], pa.binary()), pa.array([r[4] for r in own], pa.int64()), pa.array(offset[first].astype(np.int32)), pa.array(offset[last].astype(np.int32))], ["piece", "owners", "first", "last"])


def _repeated_distances(pieces: DataFrame, scratch: WorkerScratch) -> DataFrame:
    """(anchor, context, far, near) of the windows that repeat, by distance from the anchor.

    Each round sorts the groups that fit and halves the pieces of the others.
    """
    out, step = None, STEP
    while True:
        different = pieces.groupBy("core", "piece", "left", "right").agg(F.sum("n").alias("n"), F.count("*").alias("owners"))
        different = scratch.write(different, f"different-{step}")
        groups = different.groupBy("core").agg(F.count("*").alias("__different"), F.sum("n").alias("__all"), F.sum(F.octet_length("left") + F.octet_length("right") + 8).alias("__bytes"))
        groups = scratch.write(groups.where("__all > 1").drop("__all"), f"groups-{step}")
        fits = (F.col("__different") <= GROUP) | F.lit(step == 1)
        size, rest, rows = groups.agg(F.sum(F.when(fits, F.col("__bytes"))), F.count_if(~fits), F.sum("__different")).first()
        tasks = max(1, -(-int(size or 0) // TASK_BYTES))
        sorted_ = _sorted_windows(skew_safe_join(different, groups.where(fits), ["core"], "__different", int(rows or 0)), step, tasks)
        runs = sorted_.groupBy("piece", "owners").agg(F.collect_list(F.struct("first", "last")).alias("__runs"))
        runs = scratch.write(runs, f"runs-{step}")
        hits = skew_safe_join(pieces.select("piece", "anchor", "context", "far"), runs, ["piece"], "owners", pieces.count())
        hits = hits.select("anchor", "context", "far", F.explode("__runs").alias("r")).select("anchor", "context", (F.col("far") - F.col("r.first")).alias("far"), (F.col("far") - F.col("r.last")).alias("near"))
        out = hits if out is None else out.unionByName(hits)
        scratch.drop(f"different-{step}")
        if not rest:
            return out
        large = skew_safe_join(pieces, groups.where(~fits), ["core"], "__different", int(rows))
        large = large.select("core", "left", "right", "anchor", "context", "far", "n")
        pieces, step = scratch.write(large, f"pieces-{step // 2}", _halved(step)), step // 2


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row.

    Every byte goes that lies in a string of ``LENGTH`` bytes which also starts elsewhere, in the
    same or another row, as the input stands.  Null texts are empty; texts below LENGTH bytes are
    kept; repeated rows count as separate places and get equal results; null ids stay; other columns
    are ignored; an empty table gives an empty result.
    """
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    texts = texts.withColumn("__key", row_key("__id", "__text"))
    with WorkerScratch(docs.sparkSession, "suffix") as scratch:
        spots = scratch.write(texts.select("__key", "__text"), "spots", _anchor_rows())
        # An anchor that occurs once has no repeat around it.
        recurring = scratch.write(spots.groupBy("anchor").agg(F.count("*").alias("__n")).where("__n > 1"), "recurring")
        places = scratch.write(skew_safe_join(spots, recurring, ["anchor"], "__n", spots.count()).drop("__n"), "places")
        scratch.drop("spots", "recurring")
        # One of the equal contexts is cut and sorted; its weight stands for the others.
        known = places.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct("__key", "at", "low", "high")).alias("__one"))
        known = scratch.write(known, "known")
        chosen = known.select("__one.__key", F.struct("anchor", "context", "__one.at", "__one.low", "__one.high", "n").alias("__mark")).groupBy("__key").agg(F.collect_list("__mark").alias("__marks"))
        # Rows equal in id and text have one key; one of them is cut.
        marked = texts.join(chosen, "__key").dropDuplicates(["__key"]).select("__text", "__marks")
        found = _repeated_distances(scratch.write(marked, f"pieces-{STEP}", _cut()), scratch)
        found = found.groupBy("anchor", "context").agg(F.collect_list(F.struct("far", "near")).alias("__hits"))
        found = scratch.write(found.join(known.select("anchor", "context", F.col("n").alias("__n")), ["anchor", "context"]), "repeats")
        scratch.drop("known")
        ranges = skew_safe_join(places.select("__key", "anchor", "context", "at"), found, ["anchor", "context"], "__n", places.count())
        ranges = ranges.select("__key", F.transform("__hits", lambda h: F.struct((F.col("at") - h["far"]).alias("low"), (F.col("at") - h["near"]).alias("high"))).alias("__r"))
        ranges = ranges.groupBy("__key").agg(F.flatten(F.collect_set("__r")).alias("__ranges"))

        def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = text_bytes(batch.column(1))
                rows = []
                for i, own in enumerate(batch.column(2).to_pylist()):
                    low, high = (np.array([r[k] for r in own or []], np.int64) for k in ("low", "high"))
                    rows.append(_finish(data[offsets[i] : offsets[i + 1]].tobytes(), low, high))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), pa.int64(), pa.int64(), pa.string()], strict=True)] if rows else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["__id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

        left = texts.join(ranges, "__key", "left").select("__id", "__text", "__ranges")
        done = scratch.result(left, then=(finish, f"__id {kind}, {_DONE}"))
        return done.select(F.col("__id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256")
